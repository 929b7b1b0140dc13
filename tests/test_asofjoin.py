"""The as-of join against a plain search, on tables that put borders everywhere."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.operators.asofjoin import asof_join, newest_between

LEFT = "id int, key string, at timestamp_ntz, `odd.name` int"
RIGHT = "key string, known timestamp_ntz, seq int, value double, word string"


def plain(left, right):
    out = []
    for i, key, at, odd in left:
        known = [r for r in right if r[0] == key and r[1] is not None and at is not None and r[1] <= at]
        best = max(known, key=lambda r: (r[1], r[2]), default=None)
        out.append((i, key, at, odd, best and best[3], best and best[4]))
    return out


def rows_of(seed, n, m, keys):
    chance = random.Random(seed)
    at = lambda: None if chance.random() < 0.1 else ts("2024-01-01T00:00:00") + dt.timedelta(minutes=chance.randrange(60))
    left = [(i, chance.choice(keys), at(), i) for i in range(n)]
    right = [(chance.choice(keys), at(), k, None if chance.random() < 0.2 else float(k), f"w{k}") for k in range(m)]
    return left, right


@pytest.mark.parametrize("seed, n, m, keys, batch", [
    (1, 60, 40, ["a", "b", None, "d"], 3), (2, 200, 3, ["hot"], 4), (3, 3, 150, ["hot", "x"], 1), (4, 80, 80, ["a"] * 9 + ["b"], 10_000),
    (5, 50, 0, ["a", "b"], 5), (6, 0, 50, ["a"], 5)])
def test_equals_a_plain_search(spark, seed, n, m, keys, batch):
    left, right = rows_of(seed, n, m, keys)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["key"], "at", "known",
                        ["value", "word"], ["seq"], partitions=7)
        assert got.columns == ["id", "key", "at", "odd.name", "value", "word"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(left, right), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repeated_rows_and_several_keys(spark):
    left = spark.createDataFrame([(1, "a", 1, ts("2024-01-01T01:00:00"))] * 5 + [(2, "a", 2, ts("2024-01-01T01:00:00"))],
                                 "id int, k string, j int, at timestamp_ntz")
    right = spark.createDataFrame([("a", 1, ts("2024-01-01T01:00:00"), 7), ("a", 1, ts("2024-01-01T01:00:00"), 8), ("b", 2, ts("2024-01-01T00:00:00"), 9)],
                                  "k string, j int, known timestamp_ntz, v int")
    got = asof_join(left, right, ["k", "j"], "at", "known", ["v"], ["v"]).collect()
    assert sorted((r.id, r.v or 0) for r in got) == [(1, 8)] * 5 + [(2, 0)]


def test_each_side_is_exchanged_once(spark):
    """One range exchange under the sweep; nothing is exchanged by key and no row fans out."""
    left, right = (spark.range(1000).select((F.col("id") % 3).alias("key"), F.timestamp_seconds("id").cast("timestamp_ntz").alias(c), F.col("id").alias(v))
                   for c, v in (("at", "i"), ("known", "v")))
    seen = []
    import tidemark.operators.asofjoin as module
    original = module.materialised
    module.materialised = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or original(df)
    try:
        assert asof_join(left, right, ["key"], "at", "known", ["v"]).count() == 1000
    finally:
        module.materialised = original
    plan = seen[0]
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("seed, m, keys", [(7, 300, ["hot"]), (8, 120, ["a", "b", None]), (9, 0, ["a"])])
def test_rows_between_cutoffs_may_be_left_out(spark, seed, m, keys):
    """What is kept for the cutoffs gives the same join, with a row for every key and few rows for each."""
    cuts = [dt.timedelta(minutes=k) for k in (50, 10, 30)]
    begin = ts("2024-01-01T00:00:00")
    _, rows = rows_of(seed, 0, m, keys)
    right = spark.createDataFrame(rows, RIGHT)
    at = [F.lit(str(begin + c)).cast("timestamp_ntz") for c in cuts]
    kept = newest_between(right, ["key"], "known", at, ["value", "word"], ["seq"])
    left = spark.createDataFrame([(i, k, begin + c, 0) for k in keys for i, c in enumerate(cuts)], LEFT)
    whole, few = (asof_join(left, r, ["key"], "at", "known", ["value", "word"], ["seq"]) for r in (right, kept))
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    per_key = dict(kept.groupBy("key").count().collect())
    assert set(per_key) == {r[0] for r in rows} and all(n <= len(cuts) + 1 for n in per_key.values())


def test_cutoffs_join_the_forecasts_once(spark):
    """Both tables of forecasts are exchanged once, and neither is broadcast although the planner expects them small."""
    import checks.points as points
    from checks import QUERIES
    seen, original = [], points.asofjoin.materialised
    note = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or original(df)
    points.asofjoin.materialised, before = note, getattr(points, "materialised", None)
    points.materialised = note
    try:
        QUERIES["asof_join_cutoffs"](spark, "/root/testdata/sf0.001").count()
    finally:
        points.asofjoin.materialised, points.materialised = original, before
    joins = "".join(seen)
    assert joins.count("SortMergeJoin") == 1 and "Broadcast" not in joins
