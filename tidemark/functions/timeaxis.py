"""Interval-end labels, trading days and the calendar, as column expressions.

Times are ``TIMESTAMP_NTZ`` market time.  A label marks the END of its interval, so the
trading day of a label is the date 245 minutes earlier (04:05 opens a day, 04:00 closes it).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' MINUTE")


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def literal(value) -> Column:
    """Literal of a Python value; a datetime stays market time whatever zone the driver is in."""
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def trading_day(ts: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> Column:
    return (ts - minutes(offset_minutes)).cast("date")


def day_start(day: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> Column:
    """First label of a trading day."""
    return ntz(day) + minutes(offset_minutes)


def day_end(day: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES, step_minutes: int = 5) -> Column:
    """Last label of a trading day."""
    return ntz(F.date_add(day, 1)) + minutes(offset_minutes - step_minutes)


def trading_days(df: DataFrame, time_col: str, lo: str, hi: str,
                 offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> DataFrame:
    """Rows of the trading days ``lo``..``hi`` (inclusive dates).

    The bounds are put on the stored time column, where Parquet statistics can use them, and
    on ``year`` when the table is partitioned by it; a filter on the derived day could do
    neither.
    """
    first = F.to_timestamp_ntz(F.lit(f"{lo} 00:00:00")) + minutes(offset_minutes)
    stop = (F.to_timestamp_ntz(F.lit(f"{hi} 00:00:00")) + F.expr("INTERVAL '1' DAY")
            + minutes(offset_minutes))
    keep = (F.col(time_col) >= first) & (F.col(time_col) < stop)
    if "year" in df.columns:
        keep &= F.col("year").between(F.year(first), F.year(stop))
    return df.where(keep)


def cutoff_before(day: Column, hours: float) -> Column:
    """The moment ``hours`` after midnight on the calendar day before a trading day."""
    return ntz(F.date_sub(day, 1)) + minutes(round(hours * 60))


def hours_from_start(ts: Column, day: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> Column:
    micros = F.timestamp_diff("MICROSECOND", day_start(day, offset_minutes), ts)
    return micros / F.lit(3_600_000_000.0)


def start_of_day(ts: Column) -> Column:
    return ntz(ts.cast("date"))


def start_of_hour(ts: Column) -> Column:
    return ntz(F.date_trunc("hour", ts))


def interval_end_bucket(ts: Column, width: str = "30 minutes") -> Column:
    """End label of the wider interval an end label falls in (labels close their interval)."""
    return F.window(ts - F.expr("INTERVAL '0.000001' SECOND"), width).getField("end")


def period_code(ts: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES, step_minutes: int = 5) -> Column:
    """``YYYYMMDDPPP``: trading day and 1-based period of it."""
    day = trading_day(ts, offset_minutes)
    elapsed = F.timestamp_diff("MINUTE", day_start(day, offset_minutes), ts)
    period = F.floor(elapsed / F.lit(step_minutes)).cast("int") + 1
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lpad(period.cast("string"), 3, "0"))


def period_label(code: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES, step_minutes: int = 5) -> Column:
    """Interval-end label of a period code; null when the code is malformed."""
    day = F.try_to_date(F.substring(code, 1, 8), "yyyyMMdd")
    period = F.substring(code, 9, 3).try_cast("int")
    gap = F.make_dt_interval(mins=(period - 1) * step_minutes)
    return day_start(day, offset_minutes) + gap


def day_of_week(day: Column) -> Column:
    """Monday is 1."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return (day_of_week(day) >= 6).cast("int")


def season(month: Column) -> Column:
    return (F.when(month.isin(*fv.SUMMER_MONTHS), "summer")
            .when(month.isin(*fv.WINTER_MONTHS), "winter")
            .otherwise("shoulder"))


def calendar_columns(day: Column) -> dict[str, Column]:
    return {"dow": day_of_week(day), "month": F.month(day), "is_weekend": is_weekend(day),
            "season": season(F.month(day))}


def run_calendar(run: Column, target: Column, offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> dict[str, Column]:
    """Day of a run, minutes into that day, and the trading day its interval belongs to."""
    return {
        "run_day": run.cast("date"),
        "run_minute": F.timestamp_diff("MINUTE", start_of_day(run), run),
        "target_day": trading_day(target, offset_minutes),
    }
