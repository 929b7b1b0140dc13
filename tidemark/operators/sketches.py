"""Profiles that are kept: mergeable sketches of every column, by partition of the table.

A profile of new rows reads only those; sketches of all partitions merge into the profile of the table.
Counts, nulls, minimum and maximum are exact; distinct values come from HyperLogLog sketches and
quantiles from KLL sketches, within the errors below.  A sketch has a fixed size, so a group of any size
costs a few kilobytes and combines on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers: about 1.04 / sqrt(2 ** 12) = 1.6 % standard error of distinct values.
HLL_BITS = 12
#: KLL size: ranks within about 1.3 % with 99 % confidence.
KLL_SIZE = 200

KEPT = ("n_rows", "n_null", "low", "high", "distinct_sketch", "rank_sketch")


def _value(c: str, kind: str) -> Column:
    """A column as a number, times as seconds; null for kinds without an order of numbers."""
    if kind in ("string", "boolean", "binary"):
        return F.lit(None).cast("double")
    if kind in ("timestamp_ntz", "timestamp", "date"):
        return F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    return F.col(c).cast("double")


def sketch(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per partition ``by`` and column: what `merged` can add up.  One scan, one row per task and group."""
    kinds = dict(df.dtypes)
    names = [c for c in (columns or df.columns) if c not in by]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.xxhash64(F.col(c).cast("string")).alias("hash"),
                                         F.col(c).isNull().alias("none"), _value(c, kinds[c]).alias("x")) for c in names])).alias("cell")
    x = F.nanvl("cell.x", F.lit(None).cast("double"))
    return df.select(*by, cells).groupBy(*by, "cell.column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("cell.none").alias("n_null"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.hll_sketch_agg(F.when(~F.col("cell.none"), F.col("cell.hash")), F.lit(HLL_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(x, F.lit(KLL_SIZE)).alias("rank_sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups from sketches of finer ones."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("rank_sketch").alias("rank_sketch"))


def estimated(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Sketches as a profile: exact counts and bounds, estimated distinct values and quantiles (null without numbers)."""
    some = F.kll_sketch_get_n_double("rank_sketch") > 0
    kept = [c for c in sketches.columns if c not in ("distinct_sketch", "rank_sketch")]
    quantiles = F.when(some, F.kll_sketch_get_quantile_double("rank_sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return sketches.select(*kept, F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), quantiles.alias("quantiles"))
