"""An audit trail of merges that survives replays.

Every (job, batch) has a folder of entries under the log.  Before rows are appended the counts of
the merge are *planned* there; after the append the batch is *closed*.  A batch that is closed is
not merged again.  One that was planned but not closed (the process died in between) is merged
again, which adds only what is missing, and closed with the counts that were planned, so the trail
says what the batch did however often it was tried.  A failure leaves an entry of its own and the
next try may still close the batch.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources import tables
from tidemark.specs import TableSpec

ENTRY = ("table_name string, window_start string, window_end string, pulled bigint, appended bigint, duplicates bigint, "
         "already_held bigint, message string, at timestamp_ntz")
#: Folders of the log, in the order in which an entry overrides another.
PHASES = ("failed", "planned", "closed")


def entries(spark: SparkSession, log: str) -> DataFrame:
    """All entries with their ``job``, ``batch`` and ``phase``."""
    schema = f"{ENTRY}, phase string, job string, batch string"
    return tables.scan_or_empty(spark, log, spark.createDataFrame([], schema).schema)


def trail(spark: SparkSession, log: str) -> DataFrame:
    """One row per job and batch: its counts, and whether it succeeded, failed or is open."""
    rank = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase"))
    fields = [c for c in entries(spark, log).columns if c not in ("job", "batch", "phase")]
    last = entries(spark, log).groupBy("job", "batch").agg(
        F.max_by(F.struct("phase", *fields), F.struct(rank, F.col("at"))).alias("e"))
    status = (F.when(F.col("e.phase") == "closed", "success").when(F.col("e.phase") == "failed", "failed")
              .otherwise("open"))
    return last.select("job", "batch", "e.table_name", "e.window_start", "e.window_end", "e.pulled", "e.appended",
                       "e.duplicates", "e.already_held", status.alias("status"), "e.message", F.col("e.at").alias("finished_at"))


def closed(spark: SparkSession, log: str) -> set[tuple[str, str]]:
    """Jobs and batches that are closed, by the names of their folders; no entry is read."""
    at = f"{log}/phase=closed"
    return {(job.removeprefix("job="), batch.removeprefix("batch=")) for job in tables.children(spark, at) if job.startswith("job=")
            for batch in tables.children(spark, f"{at}/{job}") if batch.startswith("batch=")}


FILES = "opened bigint, failed bigint, path string, error string"


def note_files(spark: SparkSession, log: str, batch: str, opened: int, failed: dict[str, str]) -> None:
    """How many files a batch opened, and every one that could not be read, in the trail of files."""
    rows = [(opened, len(failed), path, error) for path, error in failed.items()] or [(opened, 0, None, None)]
    spark.createDataFrame(rows, FILES).coalesce(1).write.mode("overwrite").parquet(f"{log}-opened/batch={batch}")


def file_trail(spark: SparkSession, log: str) -> DataFrame:
    """``(batch, opened, failed, path, error)``: one row for each failed file, or one for a batch without any."""
    schema = spark.createDataFrame([], f"{FILES}, batch string").schema
    return tables.scan_or_empty(spark, f"{log}-opened", schema).select("batch", "opened", "failed", "path", "error")


def _note(spark: SparkSession, log: str, phase: str, job: str, batch: str, entry: dict) -> None:
    row = {**entry, "at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)}
    (spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("overwrite")
     .parquet(f"{log}/phase={phase}/job={job}/batch={batch}"))


def _noted(spark: SparkSession, log: str, phase: str, job: str, batch: str) -> dict | None:
    found = tables.scan_or_empty(spark, f"{log}/phase={phase}/job={job}/batch={batch}",
                                 spark.createDataFrame([], ENTRY).schema).first()
    return found.asDict() if found else None


def merge_once(spark: SparkSession, log: str, job: str, batch: str, target: str, spec: TableSpec,
               load: Callable[[], DataFrame], order: Sequence[Column], window: tuple[str, str] | None = None,
               stage: bool = False) -> str:
    """Merge what ``load`` gives, once per (job, batch); returns "success" or "failed".

    With ``stage`` the rows are first written to a folder of this run, which is always dropped, so
    that a slow or changing source is read once.
    """
    if _noted(spark, log, "closed", job, batch):
        return "success"
    entry = dict(table_name=spec.name, window_start=window[0] if window else None, window_end=window[1] if window else None,
                 pulled=0, appended=0, duplicates=0, already_held=0, message=None)
    bounds = tuple(F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in window) if window else None
    staged = f"{target.rstrip('/')}-stage-{uuid.uuid4().hex}" if stage else None
    planned: dict = {}

    def plan(counts: merge.Merged) -> None:
        planned.update(_noted(spark, log, "planned", job, batch) or {**entry, **counts._asdict()})
        _note(spark, log, "planned", job, batch, {k: planned[k] for k in entry})

    try:
        rows = load()
        if staged:
            rows.write.parquet(staged)
            rows = spark.read.schema(rows.schema).parquet(staged)
        merge.merge_into(spark, target, rows, spec, order, bounds, before=plan)
        _note(spark, log, "closed", job, batch, {k: planned[k] for k in entry})
        return "success"
    except Exception as e:  # any failure is recorded in full; the caller decides what follows
        _note(spark, log, "failed", job, batch, {**entry, "message": str(e)})
        return "failed"
    finally:
        if staged:
            tables.drop(spark, staged)


def merge_all(spark: SparkSession, log: str, batch: str,
              jobs: Iterable[tuple[TableSpec, str, Callable[[], DataFrame], Sequence[Column]]],
              window: tuple[str, str] | None = None) -> dict[str, str]:
    """Every table of a batch, each on its own; the status of each."""
    return {spec.name: merge_once(spark, log, spec.name, batch, target, spec, load, order, window, stage=True)
            for spec, target, load, order in jobs}
