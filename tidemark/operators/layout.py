"""Stored tables laid out so that later joins and aggregates need no exchange.

Rows are hashed into a fixed number of buckets by key, sorted inside, one file each.  Tables bucketed
alike by region and interval meet bucket by bucket: forecast prices with forecast states, both with
actual values, and the as-of selection over them read what is stored and shuffle nothing.  The
layout is chosen once, at the load; a join by more columns than the bucket keys uses it, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INTERVAL = ("regionid", "datetime")


def allow_partial_keys(spark: SparkSession) -> SparkSession:
    """Let joins by more columns than two tables are bucketed by use their buckets.

    Spark asks for all join columns by default, to guard against few large buckets; an interval of a region
    is a fine enough key.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def buckets_for(rows: int, per_bucket: int, least: int = 1) -> int:
    """Buckets that hold about ``per_bucket`` rows each, so that no task of a later join grows with the table."""
    return max(least, -(-rows // per_bucket))


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = INTERVAL,
                   mode: str = "overwrite") -> DataFrame:
    """``df`` stored in buckets below ``path`` as table ``name``; the only exchange it will need."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int,
                  keys: Sequence[str] = INTERVAL) -> DataFrame:
    """A bucketed table that another session stored, by its folder and layout; files are not read."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
