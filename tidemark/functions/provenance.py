"""Where a row came from and when it became knowable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.timeaxis import minutes, ntz


def _stamp_at(name: Column, pattern: str, fmt: str) -> Column:
    digits = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    return ntz(F.try_to_timestamp(digits, F.lit(fmt)))


def publication_time(name: Column) -> Column:
    """Publication time in a report's own name.

    Fourteen digits before the extension are the true time; a twelve-digit interval stamp is
    slightly late and so safe; a bundle name with only a date has none.
    """
    exact = _stamp_at(name, fv.PUBLISHED_STAMP, "yyyyMMddHHmmss")
    interval = _stamp_at(name, fv.INTERVAL_STAMP, "yyyyMMddHHmm")
    return F.coalesce(exact, interval)


def file_datetime(name: Column) -> Column:
    """Run stamp of a file, else the day of a bundle."""
    return F.coalesce(_stamp_at(name, fv.RUN_STAMP, "yyyyMMddHHmm"),
                      _stamp_at(name, fv.DAY_STAMP, "yyyyMMdd"))


def file_tier(path: Column) -> Column:
    return F.when(path.contains(fv.CURRENT_PATH_MARK), "report_current").otherwise("report_archive")


def stamp(df: DataFrame, source: Column, known_at: Column, kind: str, source_file: Column,
          ingested_at: Column | None = None) -> DataFrame:
    """Attach provenance.  ``ingested_at`` is one value per query unless given."""
    return df.withColumns({
        "source": source,
        "known_at": known_at,
        "known_at_kind": F.lit(kind),
        "ingested_at": ingested_at if ingested_at is not None else ntz(F.current_timestamp()),
        "source_file": source_file,
    })


def known_at_report(published: Column, file_time: Column) -> Column:
    return F.coalesce(published, file_time)


def known_at_final(interval_end: Column) -> Column:
    return interval_end + minutes(fv.FINAL_DELAY_MINUTES)


def known_at_run(written_at: Column, run_label: Column) -> Column:
    return F.coalesce(written_at, run_label - minutes(fv.RUN_LEAD_MINUTES))


def effective_known_at(known_at: Column, run_label: Column) -> Column:
    """Knowledge time used for filtering; rows without one fall back to their run label."""
    return F.coalesce(known_at, run_label - minutes(fv.RUN_LEAD_MINUTES))


def text_or_null(c: Column) -> Column:
    """Text of a run identifier, with every spelling of "missing" turned into null."""
    text = c.cast("string")
    return F.when(~text.isin(*fv.MISSING_TEXTS), text)


def vintage(df: DataFrame, columns: Sequence[str] = fv.VINTAGE_COLUMNS) -> DataFrame:
    """First present run identifier as ``vintage``; tables without one are left alone."""
    present = {c.lower(): c for c in df.columns}
    parts = []
    for name in columns:
        if name not in present:
            continue
        c = F.col(present[name])
        if dict(df.dtypes)[present[name]] in ("double", "float"):
            c = c.cast("bigint")  # a sequence number read as a float must not print as 1.0
        parts.append(text_or_null(c))
    return df.withColumn("vintage", F.coalesce(*parts)) if parts else df


def source_rank(source: Column, order: Sequence[str] = fv.SOURCE_PRECEDENCE) -> Column:
    ranked = None
    for i, name in enumerate(order, start=1):
        ranked = F.when(source == name, i) if ranked is None else ranked.when(source == name, i)
    return ranked.otherwise(len(order) + 1)
