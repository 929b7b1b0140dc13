"""Scoring a threshold rule against a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.physical import share


def benchmark_period(day: Column) -> Column:
    period = None
    for before, label in fv.BENCHMARK_PERIODS:
        hit = day < F.lit(before).cast("date")
        period = F.when(hit, label) if period is None else period.when(hit, label)
    return period.otherwise(fv.BENCHMARK_LAST_PERIOD)


def evaluate_rule(df: DataFrame, label: str = "spike", score: str = "ev_max_rrp",
                  threshold: float = fv.SPIKE_THRESHOLD, by: Sequence[Column] = (),
                  digits: int | None = 3) -> DataFrame:
    """Confusion counts and rates of "call a spike when the score exceeds the threshold".

    A row without a score is in none of the four counts; a rate over nothing is null.
    """
    yes, call = F.col(label) == 1, F.col(score) > threshold
    no, pass_ = F.col(label) == 0, F.col(score) <= threshold
    counts = df.groupBy(*by).agg(
        F.count_if(yes & call).alias("tp"), F.count_if(no & call).alias("fp"),
        F.count_if(yes & pass_).alias("fn"), F.count_if(no & pass_).alias("tn"),
        F.count(F.lit(1)).alias("n"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = {"precision": share(tp, tp + fp), "recall": share(tp, tp + fn),
             "accuracy": share(tp + tn, F.col("n"))}
    if digits is not None:
        rates = {k: F.round(v, digits) for k, v in rates.items()}
    return counts.withColumns(rates)


def crosstab(df: DataFrame, label: str, call: Column) -> DataFrame:
    """Label by call counts, one row per label value."""
    flagged = df.select(F.col(label).alias("label"), call.alias("call"))
    return flagged.groupBy("label").agg(F.count_if(~F.col("call")).alias("call_0"),
                                        F.count_if(F.col("call")).alias("call_1"))
