"""Nested reference documents to tidy rows, and back to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Rows followed by a total row of the same shape."""
    return df.unionByName(total, allowMissingColumns=True)


def melt_map(df: DataFrame, keys: Sequence[str], map_column: str, key_name: str = "key",
             value_name: str = "pct") -> DataFrame:
    """One row per entry of a map column."""
    return df.select(*keys, F.explode(map_column).alias(key_name, value_name))


def label(df: DataFrame, meta: DataFrame, key: str = "key") -> DataFrame:
    """Look up labels of keys; the lookup's size decides how it is joined."""
    return df.join(meta, key)


def label_map(df: DataFrame, labels: Mapping[str, str], key: str = "key", name: str = "label") -> DataFrame:
    """As `label`, for a handful of labels held in code."""
    lookup = F.create_map(*[F.lit(v) for kv in labels.items() for v in kv])
    return df.withColumn(name, lookup[F.col(key)]).where(F.col(name).isNotNull())


def explode_ranked(df: DataFrame, keys: Sequence[str], array_column: str, rank_name: str = "rank") -> DataFrame:
    """One row per struct of an array with its 1-based place."""
    return (df.select(*keys, F.posexplode(array_column).alias("_pos", "_item"))
            .select(*keys, (F.col("_pos") + 1).alias(rank_name), "_item.*"))


def edges(df: DataFrame, array_column: str) -> DataFrame:
    """Edge list held as an array of structs."""
    return df.select(F.inline(array_column))


def pivot_wide(df: DataFrame, index: str, names: Sequence[str], key: str = "key", value: str = "pct") -> DataFrame:
    """Long to wide with the column names given, so no pass is needed to find them."""
    return df.groupBy(index).agg(*[F.first(F.when(F.col(key) == n, F.col(value)), ignorenulls=True).alias(n)
                                   for n in names])


def weighted_average(long: DataFrame, weights: DataFrame, index: str, weight: str, key: str = "key",
                     value: str = "pct") -> DataFrame:
    """Weighted mean of each key over all groups; a group lacking a key counts as zero for it."""
    total = weights.agg(F.sum(weight).alias("_w"))
    joined = long.join(weights.select(index, weight), index)
    sums = joined.groupBy(key).agg(F.sum(F.col(value) * F.col(weight)).alias("_s"))
    return sums.select(key, (F.col("_s") / total.scalar()).alias(value))


def share_table(df: DataFrame, name: str, title: str, value: str = "pct", by: Sequence[str] = ()) -> DataFrame:
    """Positive shares under display names, largest first within each of ``by``."""
    return (df.where(F.col(value) > 0).select(*by, F.col(name).alias(title), F.col(value).alias("share"))
            .orderBy(*by, F.desc("share"), title))
