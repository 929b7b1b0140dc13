"""Idempotent key merges and partitioned writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timeaxis
from tidemark.operators import clean
from tidemark.sources import tables
from tidemark.specs import TableSpec

Window = tuple[Column, Column]


def dedup_key(columns: Sequence[str]) -> list[str]:
    """Identifying columns of a warehouse row, by what the table has."""
    have = {c.lower() for c in columns}
    key = ["regionid", "settlementdate" if "settlementdate" in have else "datetime"]
    return key + [c for c in ("vintage", "intervention") if c in have] + ["source"]


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; null key values equal each other."""
    return clean.first_by(df, list(key), list(order))


def within(df: DataFrame, time_col: str, window: Window | None) -> DataFrame:
    """Rows in ``[start, end)``, with the year bound when the table is partitioned by it."""
    if window is None:
        return df
    start, end = window
    t = F.col(time_col)
    keep = (t >= start) & (t < end)
    if "year" in df.columns:
        keep &= F.col("year").between(F.year(start), F.year(end))
    return df.where(keep)


def _match(left: DataFrame, right: DataFrame, key: Sequence[str], null_safe: bool) -> Column:
    conds = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in key]
    out = conds[0]
    for c in conds[1:]:
        out &= c
    return out


def _keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k) for k in key]).distinct()


def held(stored: DataFrame, incoming: DataFrame, key: Sequence[str], time_col: str | None = None,
         window: Window | None = None) -> DataFrame:
    """Incoming rows whose key is stored already; a null in the key never matches."""
    known = _keys(within(stored, time_col, window), key).alias("s")
    return incoming.join(known, _match(incoming, known, key, False), "left_semi")


def missing(stored: DataFrame, incoming: DataFrame, key: Sequence[str], time_col: str | None = None,
            window: Window | None = None, null_safe: bool = False) -> DataFrame:
    """Incoming rows whose key is not stored.

    With ``null_safe`` a null key equals a stored null key; without, such rows always count
    as missing.  Stored keys are deduplicated first, so a hot key meets one row.
    """
    known = _keys(within(stored, time_col, window), key)
    return incoming.join(known, _match(incoming, known, key, null_safe), "left_anti")


def merge_new(stored: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[Column],
              time_col: str | None = None, window: Window | None = None,
              keep_revisions: bool = False) -> DataFrame:
    """Rows an idempotent merge appends: first incoming row per key, unless the key is stored.

    A stored row always wins.  ``keep_revisions`` adds ``ingested_at`` to the key, so a later
    version of a row is kept beside the earlier one.
    """
    full = [*key, "ingested_at"] if keep_revisions else list(key)
    first = dedup_first(incoming, full, order)
    return missing(stored, first, full, time_col, window, null_safe=True)


def merge_counts(stored: DataFrame, incoming: DataFrame, key: Sequence[str], time_col: str | None = None,
                 window: Window | None = None, null_safe: bool = True) -> DataFrame:
    """One row: pulled rows, rows already held, rows to insert, keys added, rows not added.

    Incoming rows are counted per key before the join, so both sides have unique keys and a
    hot key cannot skew it.
    """
    per_key = incoming.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    known = _keys(within(stored, time_col, window), key).withColumn("_held", F.lit(True))
    on = _match(per_key, known, key, null_safe)
    joined = per_key.join(known, on, "left").select("_n", F.coalesce("_held", F.lit(False)).alias("_held"))
    n, h = F.col("_n"), F.col("_held")
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum(n), zero).alias("pulled"),
        F.coalesce(F.sum(F.when(h, n)), zero).alias("already_held"),
        F.coalesce(F.sum(F.when(~h, n)), zero).alias("inserted"),
        F.count_if(~h).alias("keys_added"),
    ).withColumn("duplicates", F.col("pulled") - F.col("keys_added"))


def layered(finals: DataFrame, reports: DataFrame, time_col: str, cutoff: Column) -> DataFrame:
    """Final rows before the cutoff, report rows from it on."""
    t = F.col(time_col)
    return finals.where(t < cutoff).unionByName(reports.where(t >= cutoff), allowMissingColumns=True)


def replace_slice(df: DataFrame, column: str, value: str, rows: DataFrame) -> DataFrame:
    """A table with one slice swapped out; doing it twice changes nothing."""
    keep = ~F.col(column).eqNullSafe(F.lit(value))
    return df.where(keep).unionByName(rows.where(~keep))


def by_year(df: DataFrame, time_col: str, years: Sequence[int] | None = None) -> DataFrame:
    """Rows with their partition year; rows without a time are left out."""
    out = df.where(F.col(time_col).isNotNull()).withColumn("year", F.year(time_col))
    return out.where(F.col("year").isin(*years)) if years else out


def write_partitioned(df: DataFrame, spec: TableSpec, path: str, mode: str = "append",
                      years: Sequence[int] | None = None) -> None:
    """Write year partitions, rows sorted by key inside each file.

    Rebalancing lets adaptive execution cut a hot year into several files and pack small ones
    together.  ``mode="overwrite"`` replaces only the years written.
    """
    rows = by_year(df, spec.time_col, years).hint("rebalance", "year")
    (rows.sortWithinPartitions("year", *spec.key).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path))


def write_sorted(df: DataFrame, spec: TableSpec, path: str, mode: str = "overwrite") -> None:
    """Month partitions clustered by key: every run of an interval lies together.

    Range partitioning on month and key cuts a hot month at key boundaries, so no task holds
    a whole month and files cover disjoint key ranges.
    """
    rows = df.where(F.col(spec.time_col).isNotNull()).withColumn(
        "yyyymm", F.date_format(spec.time_col, "yyyyMM"))
    (rows.repartitionByRange("yyyymm", *spec.key).sortWithinPartitions("yyyymm", *spec.key)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("yyyymm").parquet(path))


def time_bounds(df: DataFrame, time_col: str) -> Window | None:
    """Half-open window around the times of a batch; None when it has none."""
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    if lo is None:
        return None
    return timeaxis.literal(lo), timeaxis.literal(hi) + F.expr("INTERVAL '0.000001' SECOND")


class Merged(NamedTuple):
    """What a merge did with the rows it was given, which add up to ``pulled``."""

    pulled: int
    appended: int
    duplicates: int
    already_held: int


def plan_merge(spark: SparkSession, path: str, incoming: DataFrame, spec: TableSpec, order: Sequence[Column],
               window: Window | None = None, keep_revisions: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows a merge would append, and its counts, as frames.

    Only the stored years and row groups the batch's times fall in are looked up, so the cost
    of a merge follows the batch and not the table.
    """
    bounds = window or time_bounds(incoming, spec.time_col)
    stored = tables.scan_or_empty(spark, path, spec.stored_schema)
    key = [*spec.key, "ingested_at"] if keep_revisions else list(spec.key)
    return (merge_new(stored, incoming, spec.key, order, spec.time_col, bounds, keep_revisions),
            merge_counts(stored, incoming, key, spec.time_col, bounds))


def plan_once(spark: SparkSession, path: str, incoming: DataFrame, spec: TableSpec, order: Sequence[Column],
              window: Window | None = None, keep_revisions: bool = False) -> DataFrame:
    """Every key of the batch once: its first row, how many rows it has (``_n``) and whether it is stored (``_held``).

    What is appended and all counts of a merge come from this one join.
    """
    bounds = window or time_bounds(incoming, spec.time_col)
    stored = tables.scan_or_empty(spark, path, spec.stored_schema)
    key = [*spec.key, "ingested_at"] if keep_revisions else list(spec.key)
    rest = [c for c in incoming.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])) if rest else F.first(F.struct())
    per_key = incoming.groupBy(*key).agg(first.alias("_row"), F.count(F.lit(1)).alias("_n"))
    known = _keys(within(stored, spec.time_col, bounds), key).withColumn("_is", F.lit(True))
    joined = per_key.join(known, _match(per_key, known, key, True), "left")
    columns = [per_key[c] if c in key else F.col("_row").getField(c).alias(c) for c in incoming.columns]
    return joined.select(*columns, "_n", F.coalesce("_is", F.lit(False)).alias("_held"))


def _counts() -> list[Column]:
    """Counts of `Merged` over `plan_once`."""
    n, zero = F.col("_n"), F.lit(0).cast("bigint")
    return [F.coalesce(F.sum(n), zero).alias("pulled"), F.count_if(~F.col("_held")).alias("appended"),
            F.coalesce(F.sum(F.when(~F.col("_held"), n - 1)), zero).alias("duplicates"),
            F.coalesce(F.sum(F.when(F.col("_held"), n)), zero).alias("already_held")]


def _observed(seen: Observation) -> Merged | None:
    """What was observed; None if nothing was left to write, because an empty write is planned away with its metrics."""
    try:
        return Merged(*[seen.get[c] for c in Merged._fields])
    except (Py4JJavaError, KeyError):
        return None


def merge_into(spark: SparkSession, path: str, incoming: DataFrame, spec: TableSpec, order: Sequence[Column],
               window: Window | None = None, dry_run: bool = False, keep_revisions: bool = False,
               before: Callable[[Merged], None] | None = None) -> Merged:
    """Merge rows into a stored table by key and return the counts.

    Rows without a time are left out.  The batch meets the stored keys in one join.  Its counts are
    observed on the rows as they are written; ``before``, which must see them ahead of the append, has
    the joined rows kept for it.  The append reads the table's files as they were when the merge was
    planned and only adds files, so running the same batch again adds nothing.  One writer per table.
    """
    incoming = incoming.where(F.col(spec.time_col).isNotNull())
    ahead = before is not None or dry_run
    if window is None:
        incoming = incoming.persist()  # read for its bounds, then for the join
    planned = plan_once(spark, path, incoming, spec, order, window, keep_revisions)
    columns = [c for c in spec.schema.names if c in incoming.columns]
    try:
        if ahead:
            planned = planned.persist()
            merged = Merged(*planned.agg(*_counts()).first())
            if before:
                before(merged)
            if merged.appended and not dry_run:
                write_partitioned(planned.where(~F.col("_held")).select(*columns), spec, path)
            return merged
        seen = Observation()
        write_partitioned(planned.observe(seen, *_counts()).where(~F.col("_held")).select(*columns), spec, path)
        return _observed(seen) or Merged(*planned.agg(*_counts()).first())
    finally:
        if ahead:
            planned.unpersist()
        if window is None:
            incoming.unpersist()
