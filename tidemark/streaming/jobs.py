"""Structured Streaming jobs whose results equal the batch functions on the same rows.

All of them run with ``availableNow``: each start takes what has landed since the last one and
stops, with the checkpoint as the record of what was done.  Watermarks need ``TIMESTAMP``, so
``TIMESTAMP_NTZ`` market time is cast on the way in and back on the way out; the session zone
must be UTC.

Results that change as rows arrive are written as one folder per micro-batch.  A retried
batch overwrites its own folder, and readers take the newest version of each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark import fixed_values as fv
from tidemark.functions import timeaxis
from tidemark.operators import asof, batchlog, daily, merge
from tidemark.sources import reports, tables
from tidemark.specs import TableSpec

BINARY = "path string, modificationTime timestamp, length bigint, content binary"
LATENESS = "2 days"


def landed(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they land."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def landed_archives(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Zip archives as they land; file names already taken are never read again."""
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.zip")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
           mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(each).start())


def finish(q: StreamingQuery) -> None:
    """Wait for an ``availableNow`` run; its failure is raised here."""
    q.awaitTermination()


class Observed(StreamingQueryListener):
    """Metrics that streams observe on their own rows, batch by batch: no query reads the rows a second time.

    Register with ``spark.streams.addListener``; a stream names its metrics with ``stream.observe(name, ...)``.
    """

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, dict]] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            self.batches.append((name, progress.batchId, row.asDict()))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def of(self, name: str) -> list[dict]:
        """Metrics of one name, oldest batch first; a batch that was tried again counts once."""
        last = {batch: row for own, batch, row in self.batches if own == name}
        return [last[b] for b in sorted(last)]


@contextmanager
def observing(spark: SparkSession) -> Iterator[Observed]:
    """A listener for the streams that run inside; everything they observed has arrived at the end."""
    listener = Observed()
    spark.streams.addListener(listener)
    try:
        yield listener
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)


# ------------------------------------------------------------------ merges

def stream_merge(stream: DataFrame, target: str, spec: TableSpec, checkpoint: str, order: Sequence[Column],
                 log_path: str | None = None, name: str = "merge") -> StreamingQuery:
    """Append rows whose key is not stored; late and repeated rows are absorbed by key.

    With ``log_path`` every micro-batch leaves one audit entry keyed by query name and batch, which
    a replay of the batch does not change.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if log_path is None:
            merge.merge_into(spark, target, batch, spec, order)
        elif batchlog.merge_once(spark, log_path, name, str(batch_id), target, spec, lambda: batch, order) == "failed":
            raise RuntimeError(f"batch {batch_id} of {name} failed; see {log_path}")

    return _start(stream, checkpoint, each)


def stream_ingest(archives: DataFrame, target: str, spec: TableSpec, checkpoint: str,
                  source: Column | None = None,
                  order: Sequence[str] = ("known_at", "source_file")) -> StreamingQuery:
    """Unpack, parse, stamp and merge report archives as they land."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = reports.ingest(reports.unpack(batch), spec, source)
        merge.merge_into(batch.sparkSession, target, rows, spec, [F.col(c) for c in order])

    return _start(archives, checkpoint, each)


# ------------------------------------------------------------------ late data

def timed(stream: DataFrame, time_col: str, lateness: str = LATENESS, shift: Column | None = None) -> DataFrame:
    """The stream with ``_t``, the watermarked event time."""
    t = F.col(time_col) - shift if shift is not None else F.col(time_col)
    return stream.withColumn("_t", t.cast("timestamp")).withWatermark("_t", lateness)


def stream_dedup(stream: DataFrame, key: Sequence[str], time_col: str, target: str, checkpoint: str,
                 lateness: str = LATENESS) -> StreamingQuery:
    """First row of every key within the lateness bound, appended to Parquet.

    State is kept only for the bound.  Rows later than it are dropped here and recovered by
    `late_rows`.
    """
    kept = timed(stream, time_col, lateness).dropDuplicatesWithinWatermark(list(key)).drop("_t")
    return (kept.writeStream.outputMode("append").format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def late_rows(source: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows the watermark dropped, for a batch merge: keys of the source the target lacks."""
    return merge.merge_new(target, source, key, order)


# ------------------------------------------------------------------ running results

def _versions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(stream, checkpoint, each, "update")


def latest(versions: DataFrame, key: Sequence[str]) -> DataFrame:
    """Newest version of every key of a result written batch by batch."""
    rest = [c for c in versions.columns if c not in (*key, "batch_id")]
    return (versions.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
            .select(*key, "_row.*"))


def daily_counts(stream: DataFrame, time_col: str, keys: Sequence[str], measures: Sequence[Column],
                 day_offset_minutes: int, lateness: str = LATENESS) -> DataFrame:
    shifted = timed(stream, time_col, lateness, timeaxis.minutes(day_offset_minutes))
    out = shifted.groupBy(*keys, F.window("_t", "1 day").alias("_w")).agg(*measures)
    return out.withColumn("trading_day", F.col("_w.start").cast("date")).drop("_w")


def stream_daily_outcome(stream: DataFrame, path: str, checkpoint: str, threshold: float = fv.SPIKE_THRESHOLD,
                         day_offset_minutes: int = fv.DAY_OFFSET_MINUTES, lateness: str = LATENESS) -> StreamingQuery:
    """Outcome of every trading day, revised as its prices arrive; read with `latest`."""
    out = daily_counts(stream, "settlementdate", ["regionid"], daily.outcome_measures(threshold),
                       day_offset_minutes, lateness)
    return _versions(out, path, checkpoint)


def stream_tumble(stream: DataFrame, time_col: str, keys: Sequence[str], measures: Sequence[Column], path: str,
                  checkpoint: str, width: str = "30 minutes", lateness: str = LATENESS) -> StreamingQuery:
    """Wider end-labelled intervals; read with `latest` on keys and bucket_end."""
    shifted = timed(stream, time_col, lateness, F.expr("INTERVAL '0.000001' SECOND"))
    out = shifted.groupBy(*keys, F.window("_t", width).alias("_w")).agg(*measures)
    out = out.withColumn("bucket_end", timeaxis.ntz(F.col("_w.end"))).drop("_w")
    return _versions(out, path, checkpoint)


def stream_asof_latest(stream: DataFrame, hours: float, values: Sequence[str], path: str, checkpoint: str,
                       lateness: str = LATENESS) -> StreamingQuery:
    """Newest forecast of every interval knowable at the cutoff; read with `latest`.

    The state is one row per interval however many runs arrive, and is dropped once the
    interval lies further back than the lateness bound.
    """
    known = timed(asof.known_by(stream, hours), "datetime", lateness)
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(asof.recency(stream))])
    out = known.groupBy("regionid", "_t", "trading_day").agg(
        F.max_by(F.struct(*values), rank).alias("_row"))
    out = out.select("regionid", timeaxis.ntz(F.col("_t")).alias("datetime"), "trading_day", "_row.*")
    return _versions(out, path, checkpoint)


def stream_coverage(stream: DataFrame, time_col: str, path: str, checkpoint: str,
                    lateness: str = LATENESS) -> StreamingQuery:
    """Rows per calendar day as they arrive; read with `latest`, judge with `thin`."""
    out = daily_counts(stream, time_col, [], [F.count(F.lit(1)).alias("n_rows")], 0, lateness)
    return _versions(out.withColumnRenamed("trading_day", "day"), path, checkpoint)


def thin(counts: DataFrame, as_of: str, days: int, expected: float, share: float = fv.THIN_SHARE) -> DataFrame:
    """Recent whole days of a coverage result with too few rows, absent days included."""
    today = F.lit(as_of).cast("date")
    spine = counts.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))).alias("day"))
    n = F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows")
    return spine.join(counts, "day", "left").select("day", n).where(F.col("n_rows") < expected * share)
