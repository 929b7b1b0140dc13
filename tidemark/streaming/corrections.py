"""Running results that stay right however late a row arrives, and their compaction.

A watermark bounds the state of a running aggregate and drops what comes later.  Here no state is
kept: every micro-batch stores its rows by day, finds the keys they touch, computes those keys again
from all stored rows with the batch function, and publishes them as a newer version.  A row a year
late costs one reading of its day.

Results and stored rows are folders ``batch_id=<n>``; a replayed batch overwrites its own.  `compact`
merges ``FAN_IN`` folders in a row into one ``span=<first>-<last>``, and ``FAN_IN`` spans of a size into
a larger one, so n batches leave about ``FAN_IN * log(n)`` folders and a row is rewritten ``log(n)``
times.  A span counts from the moment its ``_SUCCESS`` marker is there and hides the folders inside it,
so readers see either the old folders or the new one.  What a compaction replaced is dropped by the
next one, which gives readers that started earlier their files until then.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import tables
from tidemark.streaming import jobs

#: Folders in a row that become one.
FAN_IN = 10
#: Days a batch may touch that are named one by one when stored rows are read; more are a range.
MOST_DAYS = 400


def _folders(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """Complete folders below a path by their first and last batch."""
    out = {}
    for name in tables.children(spark, path):
        kind, _, number = name.partition("=")
        if kind in ("batch_id", "span") and tables.exists(spark, f"{path}/{name}/_SUCCESS"):
            first, _, last = number.partition("-")
            out[int(first), int(last or first)] = f"{path}/{name}"
    return out


def current(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """What readers see now, in order: the folders that lie in no other one."""
    found = _folders(spark, path)
    return {(a, b): found[a, b] for a, b in sorted(found)
            if not any((c, d) != (a, b) and c <= a and b <= d for c, d in found)}


def _read(spark: SparkSession, parts: Mapping[tuple[int, int], str], schema: T.StructType) -> DataFrame:
    """Rows of the given folders; a batch folder has one number for all its rows, a span keeps theirs."""
    full = T.StructType([f for f in schema if f.name != "batch_id"])
    frames = []
    for (first, _), folder in parts.items():
        own = "/span=" in folder
        rows = spark.read.schema(T.StructType([*full, T.StructField("_version", T.LongType())]) if own else full).parquet(folder)
        frames.append(rows.select(*full.names, (F.col("_version") if own else F.lit(first).cast("bigint")).alias("batch_id")))
    return reduce(DataFrame.unionByName, frames)


def versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of every current folder with the ``batch_id`` that wrote them."""
    parts = current(spark, path)
    if not parts:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("bigint"))
    return _read(spark, parts, schema)


def latest(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Newest version of every key of a published result."""
    return jobs.latest(versions(spark, path, schema), key)


def _write(rows: DataFrame, folder: str, by: Sequence[str] = ()) -> None:
    """A whole folder, marked when complete; a dynamic overwrite would leave it unmarked."""
    writer = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(folder)


def plan(parts: Sequence[tuple[int, int]], fan_in: int = FAN_IN) -> list[tuple[int, int]] | None:
    """The longest row of last folders of about one size, if ``fan_in`` of them are there."""
    level = [_level(b - a + 1, fan_in) for a, b in parts]
    for start in range(len(parts) - fan_in + 1):
        if len({*level[start:]}) == 1:
            return list(parts[start:])
    return None


def _level(batches: int, fan_in: int) -> int:
    level = 1
    while batches >= fan_in ** level:
        level += 1
    return level


def compact(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] | None = None,
            by: Sequence[str] = (), fan_in: int = FAN_IN, whole: bool = False) -> int:
    """Merge folders as planned, or all of them; returns how many merges that took.

    With ``key`` only the newest version of each key is kept, else every row.  ``by`` are partition
    columns.  Files come out at the size adaptive execution aims for, however many went in.
    """
    merges = 0
    while True:
        parts = current(spark, path)
        chosen = (list(parts) if len(parts) > 1 else None) if whole else plan(list(parts), fan_in)
        if not chosen:
            return merges
        stale = [at for span, at in _folders(spark, path).items() if span not in parts]
        rows = _read(spark, {c: parts[c] for c in chosen}, schema)
        if key:
            rest = [c for c in rows.columns if c not in key]
            rows = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row")).select(*key, "_row.*")
        _write(rows.withColumnRenamed("batch_id", "_version"), f"{path}/span={chosen[0][0]}-{chosen[-1][1]}", by)
        merges += 1
        for at in stale:  # what an earlier merge replaced
            tables.drop(spark, at)


def corrected(stream: DataFrame, keys: Mapping[str, Column], day: Column, result: Callable[[DataFrame], DataFrame],
              path: str, checkpoint: str, fan_in: int = FAN_IN) -> StreamingQuery:
    """Publish ``result`` of every key that arriving rows touch, computed from all rows stored so far.

    ``keys`` name the groups of the result (columns of the same names come out of it), ``day`` is the day
    a row is stored under; rows of a group lie on a bounded number of days.  Rows are kept below
    ``<path>-rows``.  Read the result with `latest`.
    """
    rows_at = f"{path.rstrip('/')}-rows"
    stored_schema = T.StructType([*stream.schema, T.StructField("_day", T.DateType())])
    names = [f"_k{i}" for i in range(len(keys))]

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = batch.withColumn("_day", day)
        _write(arrived, f"{rows_at}/batch_id={batch_id}", ["_day"])
        mine = spark.read.schema(stored_schema).parquet(f"{rows_at}/batch_id={batch_id}")
        touched = mine.select("_day", *[c.alias(n) for n, c in zip(names, keys.values())]).distinct().persist()
        try:
            groups = touched.select(*names).distinct()
            # The days of a touched group reach at most one to either side of those its new rows fall on.
            near = touched.select(F.explode(F.array(F.date_sub("_day", 1), "_day", F.date_add("_day", 1))).alias("d")).distinct()
            days = [r.d for r in near.limit(MOST_DAYS + 1).collect()]
            if not days:
                return
            if len(days) <= MOST_DAYS:
                wanted = F.col("_day").isin([d for d in days if d is not None])
            else:
                wanted = F.col("_day").between(*near.agg(F.min("d"), F.max("d")).first())
            if None in days or len(days) > MOST_DAYS:  # rows without a time are a day of their own
                wanted |= F.col("_day").isNull()
            stored = versions(spark, rows_at, stored_schema).where(wanted).drop("batch_id")
            named = stored.withColumns({f"_of{n}": c for n, c in zip(names, keys.values())})
            same = [F.col(f"_of{n}").eqNullSafe(F.col(n)) for n in names]
            out = result(named.join(groups, same, "left_semi").select(*batch.columns))
            _write(out, f"{path}/batch_id={batch_id}")
            compact(spark, rows_at, stored_schema, by=["_day"], fan_in=fan_in)
            compact(spark, path, out.schema, list(keys), fan_in=fan_in)
        finally:
            touched.unpersist()

    return jobs._start(stream, checkpoint, each)
