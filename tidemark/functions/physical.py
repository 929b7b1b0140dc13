"""Derived market measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def margin(generation: Column, demand: Column) -> Column:
    return generation - demand


def derived_physical() -> dict[str, Column]:
    """Ramp, curtailment and intermittent-forecast error of an actual state row."""
    return {
        "ramp": F.col("clearedsupply") - F.col("initialsupply"),
        "curtailment": F.col("uigf") - F.col("semischedule_clearedmw"),
        "intermittent_error": F.col("totalintermittentgeneration") - F.col("uigf"),
    }


def sensitivity_spread(columns: Sequence[str] = fv.SENSITIVITY_COLUMNS) -> Column:
    """Gap between the dearest and cheapest populated scenario; null when none is."""
    return F.greatest(*columns) - F.least(*columns)


def clip(c: Column, lo: float = fv.CLIP_RANGE[0], hi: float = fv.CLIP_RANGE[1]) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is null for a zero divisor."""
    return top / F.nullif(bottom, F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """Quotient of two counts; null for an empty whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
