"""The back-fill job: final values from monthly extracts up to a cutoff, reports from there on.

The months of every table and the windows of report files are units of stored work plans.  Each unit is
one merge in the batch log, so a run that was killed goes on with the first unit that is not closed, and
a repeated run does nothing.  A month is read, shaped and merged on its own: memory and the size of a retry
follow a month, not the years asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import provenance, timeaxis
from tidemark.operators import batchlog, clean, merge
from tidemark.plans import ingest
from tidemark.sources import tables
from tidemark.specs import SPECS, TableSpec

FINAL_SOURCE = "mmsdm"
#: Column names of extracts that differ from those of the reports.
EXTRACT_NAMES = {"predispatch_run_datetime": "run_datetime"}

Extract = Callable[[str, int, int], DataFrame | None]


def extract_folder(spark: SparkSession, folder: str) -> Extract:
    """Monthly extracts stored as ``<folder>/<table>/<yyyymm>``; None for a month without one."""
    def read(table: str, year: int, month: int) -> DataFrame | None:
        path = f"{folder.rstrip('/')}/{table}/{year}{month:02d}"
        return spark.read.parquet(path) if tables.exists(spark, path) else None

    return read


def finals(extract: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of an extract as rows of the table: typed, of known regions, with provenance and vintage.

    An interval's final value counts as known five minutes after its end; a forecast run when it was
    written, and row by row half an hour before its label where that is missing.
    """
    named = extract.withColumnsRenamed({c: c.lower() for c in extract.columns}).withColumnsRenamed(EXTRACT_NAMES)
    if spec.is_forecast:
        written = F.col("run_written_at") if "run_written_at" in named.columns else F.lit(None).cast("timestamp_ntz")
        known = provenance.known_at_run(written, F.col("run_datetime"))
        named = provenance.vintage(named)
    else:
        known = provenance.known_at_final(F.col(spec.time_col))
    stamped = provenance.stamp(named, F.lit(FINAL_SOURCE), known, "estimated", F.lit(FINAL_SOURCE))
    return clean.tidy(stamped, spec)


def months(start: dt.datetime, cutoff: dt.datetime) -> list[tuple[dt.datetime, dt.datetime]]:
    """Calendar months of ``[start, cutoff)``, the first and last cut to it."""
    out, at = [], start
    while at < cutoff:
        after = dt.datetime(at.year + at.month // 12, at.month % 12 + 1, 1)
        out.append((at, min(after, cutoff)))
        at = after
    return out


def backfill(spark: SparkSession, extract: Extract, listing: DataFrame, read: Callable[[list[str]], DataFrame],
             stores: Mapping[str, str], start: dt.datetime, cutoff: dt.datetime, end: dt.datetime, log: str, job: str,
             scratch: str, order: tuple[str, ...] = ("known_at",), most_files: int = ingest.MOST_FILES) -> dict[str, str]:
    """Status of every unit that was open: ``table/yyyymm`` of the finals, then the tables of the reports.

    Rows from ``start`` on are taken.  The cutoff moves as months are published: a later run under a new job
    name fills the months since, and rows that are stored already are not added again.
    """
    done: dict[str, str] = {}
    closed = batchlog.closed(spark, log)
    for name, path in stores.items():
        spec = SPECS[name]
        plan = ingest.work_plan(spark, f"{log}-plan/job={job}-finals-{name}", lambda: [(a, b, None) for a, b in months(start, cutoff)])
        for unit in plan:
            batch = f"{job}-finals-{unit.start:%Y%m}"
            if (spec.name, batch) in closed:
                continue
            rows = extract(name, unit.start.year, unit.start.month)
            if rows is None:
                done[f"{name}/{unit.start:%Y%m}"] = "absent"
                continue
            t = F.col(spec.time_col)
            kept = finals(rows, spec).where((t >= timeaxis.literal(unit.start)) & (t < timeaxis.literal(unit.end)))
            done[f"{name}/{unit.start:%Y%m}"] = batchlog.merge_once(
                spark, log, spec.name, batch, path, spec, lambda kept=kept: kept, [F.col(c) for c in order])
    reports = ingest.ingest_range(spark, listing, read, stores, timeaxis.literal(cutoff), timeaxis.literal(end), log, f"{job}-reports",
                                  scratch, most_files, ("known_at", "source_file", *order[1:]))
    return {**done, **{f"{name}/reports": status for name, status in reports.status.items()}}


def rebuild_from(spark: SparkSession, path: str, rows: DataFrame, spec: TableSpec, start: Column) -> None:
    """Replace everything from ``start`` on by ``rows``; what is stored before it stays.

    Only the years from the start on are written.  The kept part of its year is staged first, because a
    partition cannot be read while it is replaced.
    """
    t = F.col(spec.time_col)
    year = rows.sparkSession.range(1).select(F.year(start)).first()[0]
    stored = tables.scan_or_empty(spark, path, spec.stored_schema)
    kept = stored.where((F.col("year") == year) & (t < start)).drop("year")
    staged = f"{path.rstrip('/')}-rebuild"
    columns = [c for c in spec.schema.names if c in rows.columns]
    try:
        merge.by_year(kept.select(*columns).unionByName(rows.where(t >= start).select(*columns)), spec.time_col).write.mode(
            "overwrite").parquet(staged)
        fresh = spark.read.schema(spec.stored_schema).parquet(staged).select(*columns)
        merge.write_partitioned(fresh, spec, path, "overwrite")
        wanted = {r.year for r in merge.by_year(fresh, spec.time_col).select("year").distinct().collect()}
        for name in tables.children(spark, path):  # later years that the new rows do not reach
            _, _, number = name.partition("year=")
            if number.isdigit() and int(number) >= year and int(number) not in wanted:
                tables.drop(spark, f"{path}/{name}")
    finally:
        tables.drop(spark, staged)
