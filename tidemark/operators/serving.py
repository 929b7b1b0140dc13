"""Range reads, paging and plain-text output."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv
from tidemark.functions.timeaxis import literal
from tidemark.specs import TableSpec


def page_order(spec: TableSpec) -> list[str]:
    """A total order of rows: time, region, then the rest of the key."""
    first = [spec.time_col, "regionid"]
    return first + [c for c in spec.key if c not in first]


def range_read(df: DataFrame, spec: TableSpec, start: str, end: str, region: str | None = None) -> DataFrame:
    """Rows of ``[start, end)``, optionally of one region; unknown regions give no rows."""
    if end <= start:
        raise ValueError("end must be after start")
    t = F.col(spec.time_col)
    lo, hi = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in (start, end))
    keep = (t >= lo) & (t < hi)
    if "year" in df.columns:
        keep &= F.col("year").between(F.year(lo), F.year(hi))
    if region:
        keep &= F.col("regionid") == region.upper()
    return df.where(keep)


def range_last_days(df: DataFrame, spec: TableSpec, as_of: str, days: int, region: str | None = None,
                    ahead: int = fv.LOOKAHEAD_DAYS) -> DataFrame:
    """The last N days up to the furthest forecast, relative to an explicit day."""
    if not 1 <= days <= 31:
        raise ValueError("days must be 1 to 31")
    today = dt.date.fromisoformat(as_of)
    return range_read(df, spec, str(today - dt.timedelta(days)), str(today + dt.timedelta(ahead)), region)


def _check_limit(limit: int) -> None:
    if not 1 <= limit <= fv.MAX_PAGE_ROWS:
        raise ValueError(f"limit must be 1 to {fv.MAX_PAGE_ROWS}")


def page(rows: DataFrame, order: Sequence[str], limit: int = fv.PAGE_ROWS, offset: int = 0) -> DataFrame:
    """One page in a total order."""
    _check_limit(limit)
    return rows.orderBy(*order).offset(offset).limit(limit)


def next_offset(returned: int, offset: int, limit: int) -> int | None:
    """Where the next page starts; None when this one was not full."""
    return offset + limit if returned == limit else None


def page_after(rows: DataFrame, order: Sequence[str], after: Mapping[str, object] | None,
               limit: int = fv.PAGE_ROWS) -> DataFrame:
    """The page behind a known last row: cost does not grow with depth.

    The bound on the leading column reaches the scan, the full comparison settles ties.
    """
    _check_limit(limit)
    if after:
        lead = order[0]
        mine = F.struct(*order)
        last = F.struct(*[literal(after[c]).alias(c) for c in order])
        rows = rows.where((F.col(lead) >= literal(after[lead])) & (mine > last))
    return rows.orderBy(*order).limit(limit)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, NaN as null."""
    def one(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema])


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, nulls spelled out."""
    return plain(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def export_csv(df: DataFrame, path: str, drop: Sequence[str] = ()) -> None:
    """CSV with a header, without the given columns; one file per task."""
    plain(df.drop(*drop)).write.mode("overwrite").option("header", True).csv(path)
