"""What a warehouse table is: schema, time column and identifying key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark import fixed_values as fv


@dataclass(frozen=True)
class TableSpec:
    name: str
    time_col: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]

    @property
    def is_forecast(self) -> bool:
        return "vintage" in self.key

    @property
    def schema(self) -> T.StructType:
        """Declared schema of a row: measures, provenance and, for forecasts, vintage."""
        stored = self.columns + fv.PROVENANCE
        if self.is_forecast:
            stored += (("vintage", "string"),)
        return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in stored))

    @property
    def stored_schema(self) -> T.StructType:
        """`schema` plus the partition column of the stored table."""
        return self.schema.add("year", T.IntegerType())


def _spec(name: str) -> TableSpec:
    forecast = name.startswith("pre")
    time_col = "datetime" if forecast else "settlementdate"
    run = ("vintage",) if forecast else ()
    return TableSpec(name, time_col, ("regionid", time_col, *run, "intervention", "source"),
                     fv.KEEP[name])


SPECS = {name: _spec(name) for name in fv.KEEP}


@dataclass(frozen=True)
class Params:
    """Knobs of the daily feature build; the defaults are the market's rules."""

    threshold: float = fv.SPIKE_THRESHOLD
    day_offset_minutes: int = fv.DAY_OFFSET_MINUTES
    expected_intervals: int = fv.INTERVALS_PER_DAY
    exact_intervals: bool = True
    min_periods: int = fv.MIN_FORECAST_PERIODS
    rolling_rows: int = fv.ROLLING_ROWS
    cutoff_hours: dict = field(default_factory=lambda: {
        "fc": fv.EARLY_CUTOFF_HOURS, "ev": fv.DECISION_CUTOFF_HOURS})
