"""Exact quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one task.  That is right for groups
bounded by the clock (one row per interval of a day) and wrong for whole tables, so large
groups are counted by value, put in order by a range partition, and ranked in place: totals of
the partitions say in which of them a wanted rank lies, and only those are ordered inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialised


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                    count: str | None = None, partitions: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles per group: ``keys``, ``n`` and ``q`` (array as ``probs``).

    ``count`` names a column saying how many rows each row stands for.

    1. count every distinct value per group (combines on the map side);
    2. put the counted values in order of group and value by a range partition, once, stored so that its
       parts stay as they are: as many parts as the data fill, whatever the size of a group;
    3. total the parts, offset them, find those holding a wanted rank, and order values in those only.
    """
    keys = list(keys)
    group = keys or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(0))
    x, n = F.col("_x"), F.col("_n")
    weight = F.col(count) if count else F.lit(1)
    counts = (base.select(*group, F.col(value).cast("double").alias("_x"), weight.alias("_w"))
              .where(x.isNotNull() & ~F.isnan(x)).groupBy(*group, "_x").agg(F.sum("_w").alias("_n")))
    place = [*group, "_x"]
    ordered = counts.repartitionByRange(partitions, *place) if partitions else counts.repartitionByRange(*place)
    sliced = materialised(ordered).withColumn("_slice", F.spark_partition_id())

    # From here to `hits` there is a row for each group and part, then `2 * len(probs)` per group.
    totals = sliced.groupBy(*group, "_slice").agg(F.sum("_n").alias("_total"))
    order = Window.partitionBy(*group).orderBy("_slice")
    running = totals.withColumns({"_before": F.sum("_total").over(order) - F.col("_total"),
                                  "_size": F.sum("_total").over(Window.partitionBy(*group))})
    spans = running.groupBy(*group, "_size").agg(
        F.collect_list(F.struct("_slice", "_before", "_total")).alias("_spans"))
    wanted = spans.select(*group, "_size", "_spans", F.explode(_places(probs, F.col("_size"))).alias("_p"))
    span = F.element_at(F.filter("_spans", lambda s: (s["_before"] <= F.col("_p.place"))
                                 & (F.col("_p.place") < s["_before"] + s["_total"])), 1)
    hits = (wanted.select(*group, "_size", "_p", span.alias("_span"))
            .groupBy(*group, "_size", F.col("_span._slice").alias("_slice"), F.col("_span._before").alias("_before"))
            .agg(F.collect_list("_p").alias("_places")))

    inside = _join(sliced, hits, [*group, "_slice"])
    upto = F.sum("_n").over(Window.partitionBy(*group, "_slice").orderBy("_x")
                            .rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.withColumn("_end", F.col("_before") + upto)
    here = F.filter("_places", lambda p: (p["place"] >= F.col("_end") - n) & (p["place"] < F.col("_end")))
    found = ranked.select(*group, "_size", "_x", F.explode(here).alias("_p"))
    each = found.groupBy(*group, "_size", F.col("_p.prob").alias("prob")).agg(
        F.sum(F.col("_p.weight") * x).alias("v"))
    return (each.groupBy(*group, "_size").agg(F.array_sort(F.collect_list(F.struct("prob", "v"))).alias("_q"))
            .select(*keys, F.col("_size").alias("n"), F.col("_q.v").alias("q")))


def _places(probs: Sequence[float], size: Column) -> Column:
    """Zero-based ranks each quantile lies on or between, with their weights."""
    def two(p: Column, i: Column) -> Column:
        rank = p * (size - 1)
        low = F.floor(rank)
        return F.array(F.struct(i.alias("prob"), low.alias("place"), (1 - (rank - low)).alias("weight")),
                       F.struct(i.alias("prob"), (low + 1).alias("place"), (rank - low).alias("weight")))

    both = F.flatten(F.transform(F.array(*[F.lit(float(p)) for p in probs]), two))
    return F.filter(both, lambda p: p["weight"] > 0)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that also pairs null group keys."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on &= left[k].eqNullSafe(right[f"_r_{k}"])
    return left.join(right, on).drop(*[f"_r_{k}" for k in keys])
