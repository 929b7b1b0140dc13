"""The incremental batch job: list, select, skip what is stored, read only the rest, parse, merge.

`ingest_window` takes the files of one window; `ingest_range` cuts any range into consecutive windows of a
bounded number of files, stored as a work plan before the first is read, so a run that was killed goes
on where it stopped and a back-fill of years is the same job as a day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import timeaxis
from tidemark.operators import batchlog, quality
from tidemark.sources import files, reports, tables
from tidemark.specs import SPECS

#: Files of one window, whose paths the driver hands to the reader.
MOST_FILES = 100_000
PLAN = "seq bigint, start timestamp_ntz, end timestamp_ntz, files bigint"


@dataclass
class Ingested:
    """What a run did: archives opened, those that were broken, and the status of each table."""

    opened: int = 0
    broken: dict[str, str] = field(default_factory=dict)
    status: dict[str, str] = field(default_factory=dict)


def folder_source(spark: SparkSession, folder: str) -> tuple[DataFrame, Callable[[list[str]], DataFrame]]:
    """Listing and reader of zip files below a folder."""
    return files.listing(spark, folder, "*.[zZ][iI][pP]"), lambda paths: reports.read_archives(spark, paths)


def ingest_window(spark: SparkSession, listing: DataFrame, read: Callable[[list[str]], DataFrame],
                  stores: Mapping[str, str], start: Column, end: Column, log: str, batch: str, scratch: str,
                  order: tuple[str, ...] = ("known_at", "source_file")) -> Ingested:
    """Merge the unseen files stamped within ``[start, end)`` into every table of ``stores``.

    Files already read for all tables are never opened again.  Archives are unpacked once for all
    tables, into a folder under ``scratch`` that is dropped at the end.  A broken archive is
    reported and does not stop the others; tables fail or succeed on their own.
    """
    specs = {name: SPECS[name] for name in stores}
    stored = {name: tables.scan_or_empty(spark, path, specs[name].stored_schema) for name, path in stores.items()}
    each = F.explode(F.array(*[F.lit(n) for n in specs])).alias("table_name")
    wanted = files.select_files(listing, start, end).select("path", "name", each)
    # A file may have been read and have left no row, because all its keys were stored already.
    opened = tables.scan_or_empty(spark, f"{log}-files", spark.createDataFrame([], "table_name string, source_file string").schema)
    seen = files.seen_manifest(stored).unionByName(opened)
    unseen = files.skip_seen(wanted, seen).select("table_name", "path", "name").persist()
    lines_at = f"{scratch.rstrip('/')}/{batch}-lines"
    done = Ingested()
    try:
        # `ingest_range` keeps windows to a bounded number of files.
        paths = [r.path for r in unseen.select("path").distinct().collect()]
        if not paths:
            return done
        done.opened = len(paths)
        lines = reports.stored_lines(reports.unpack(read(sorted(paths))), lines_at)
        done.broken = {r.path: r.error for r in reports.failures(lines).collect()}  # at most one row a file

        def load(name: str) -> Callable[[], DataFrame]:
            fresh = unseen.where(F.col("table_name") == name).select(F.col("name").alias("source_file"))
            return lambda: reports.ingest(lines, specs[name]).join(fresh, "source_file", "left_semi")

        batchlog.note_files(spark, log, batch, len(paths), done.broken)
        done.status = batchlog.merge_all(spark, log, batch, [
            (spec, stores[name], load(name), [F.col(c) for c in order]) for name, spec in specs.items()])
        good = [name for name, status in done.status.items() if status == "success"]
        read_whole = unseen.where(F.col("table_name").isin(good)).join(
            reports.failures(lines).select("path").distinct(), "path", "left_anti")
        read_whole.select("table_name", F.col("name").alias("source_file")).write.mode("append").parquet(f"{log}-files")
        return done
    finally:
        unseen.unpersist()
        tables.drop(spark, lines_at)


def windows(listing: DataFrame, start: Column, end: Column, most: int = MOST_FILES) -> list[tuple]:
    """Consecutive windows ``(start, end, files)`` of ``[start, end)`` with about ``most`` files each.

    Files are counted per stamp; a window ends with the stamp that fills it, so equal stamps stay
    together.  The running sum is over stamps, which the clock bounds.
    """
    counts = files.select_files(listing, start, end).groupBy("file_ts").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("file_ts").rowsBetween(Window.unboundedPreceding, -1))
    cut = counts.withColumn("w", F.floor(F.coalesce(upto, F.lit(0)) / most)).groupBy("w").agg(
        F.min("file_ts").alias("first"), F.sum("n").alias("n")).orderBy("w").collect()
    lo, hi = listing.sparkSession.range(1).select(start.alias("a"), end.alias("b")).first()
    begins = [lo, *[r.first for r in cut[1:]]]
    return [(a, b, r.n) for a, b, r in zip(begins, [*begins[1:], hi], cut)]


def work_plan(spark: SparkSession, path: str, make: Callable[[], list[tuple]]) -> list:
    """The stored plan below ``path``, or a new one, stored before any of it is done."""
    stored = tables.scan_or_empty(spark, path, spark.createDataFrame([], PLAN).schema).orderBy("seq").collect()
    if not stored:
        rows = [(k, *r) for k, r in enumerate(make())]
        spark.createDataFrame(rows, PLAN).coalesce(1).write.mode("overwrite").parquet(path)
        stored = tables.scan_or_empty(spark, path, spark.createDataFrame([], PLAN).schema).orderBy("seq").collect()
    return stored


def ingest_range(spark: SparkSession, listing: DataFrame, read: Callable[[list[str]], DataFrame], stores: Mapping[str, str],
                 start: Column, end: Column, log: str, job: str, scratch: str, most: int = MOST_FILES,
                 order: tuple[str, ...] = ("known_at", "source_file")) -> Ingested:
    """`ingest_window` over consecutive windows of a stored plan; windows that are closed are not opened again.

    A window with a failed table is left open and the next ones go on; the result says what failed.
    """
    total = Ingested()
    plan = work_plan(spark, f"{log}-plan/job={job}", lambda: windows(listing, start, end, most))
    closed = batchlog.closed(spark, log)
    for w in plan:
        batch = f"{job}-{w.seq:06d}"
        if all((SPECS[name].name, batch) in closed for name in stores):
            continue
        one = ingest_window(spark, listing, read, stores, timeaxis.literal(w.start), timeaxis.literal(w.end), log, batch, scratch, order)
        total.opened += one.opened
        total.broken.update(one.broken)
        for name, status in one.status.items():
            total.status[name] = "failed" if "failed" in (status, total.status.get(name)) else status
    return total


def thin_days(spark: SparkSession, stores: Mapping[str, str], expected: Mapping[str, float], as_of: str, days: int = fv.THIN_DAYS) -> DataFrame:
    """``(table_name, day, n_rows)`` of the last whole days of each table that look thin, days without rows included.

    The end of every daily job: a job that fetched nothing looks like success otherwise.
    """
    out = []
    for name, path in stores.items():
        spec = SPECS[name]
        stored = tables.scan_or_empty(spark, path, spec.stored_schema)
        recent = quality.thin_days(stored, spec.time_col, as_of, days, expected[name])
        out.append(recent.select(F.lit(name).alias("table_name"), "day", "n_rows"))
    return tables.union_all(out)
