"""Profiles, exact quantiles, evaluation, dictionary and reshaping."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from conftest import same_rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import catalog, evaluate, explore, quality, reshape
from tidemark.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def brute(values, probs=PROBS):
    return [float(np.quantile(np.array(values), p)) for p in probs]


def test_quantiles_with_ties_nulls_and_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(3000)] + [("tied", float(i % 3)) for i in range(500)]
    rows += [("one", 7.0), (None, 1.0), (None, 2.0), ("hot", None), ("tied", float("nan")), ("void", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: (r.n, list(r.q)) for r in exact_quantiles(df, "x", PROBS, ["g"]).collect()}
    groups = {}
    for g, x in rows:
        if x is not None and not math.isnan(x):
            groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g][0] == len(xs) and got[g][1] == pytest.approx(brute(xs))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_of_any_list(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = exact_quantiles(df, "x", PROBS, partitions=5).first()
    assert got.n == len(xs) and list(got.q) == pytest.approx(brute(xs))


def test_quantiles_from_counted_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1)], "x double, c int")
    assert list(exact_quantiles(df, "x", [0.5, 1.0], count="c").first().q) == [1.0, 5.0]


def test_quantile_bins_merge_repeated_edges(spark):
    xs = [0.0] * 50 + [float(i) for i in range(1, 51)]
    df = spark.createDataFrame([(x, x * 2) for x in xs], "b double, v double")
    got = {r.bin: r for r in explore.quantile_bins(df, "b", "v").collect()}
    assert sum(r.n for r in got.values()) == 100 and min(got) == 1
    assert got[1].lowest == 0.0 and got[1].n >= 50  # equal values never split


def test_histogram_edges(spark):
    xs = [-200.1, 500.1, 0.0] + [-200 + 3.5 * k for k in range(201)]  # every bin edge, the top one included
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.bin: r.n for r in explore.histogram(df, "x", []).collect()}
    want, _ = np.histogram(xs, bins=200, range=(-200, 500))
    assert got == {i + 1: int(n) for i, n in enumerate(want) if n}


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = explore.sample_rows(df, 50, ["k"]), explore.sample_rows(df.repartition(9), 50, ["k"])
    same_rows(a, b)
    brute_force = sorted(range(1000), key=lambda k: hashlib.md5(f"{k}|0".encode()).hexdigest())[:50]
    assert {r.k for r in a.collect()} == set(brute_force)
    assert explore.sample_rows(df, 5000, ["k"]).count() == 1000 and explore.sample_rows(df, 0, ["k"]).count() == 0
    assert explore.sample_rows(df, 50, ["k"], seed=1).join(a, "k").count() < 50


def test_thin_days_report_days_without_rows(spark):
    rows = [(ts(f"2024-01-0{d}T00:00:00"),) for d in (1, 1, 1, 2, 4, 4, 4)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = {str(r.day): r.n_rows for r in quality.thin_days(df, "t", "2024-01-04", 3, 3).collect()}
    assert got == {"2024-01-02": 1, "2024-01-03": 0}  # the 4th is still filling


def test_rule_without_score_is_uncounted(spark):
    df = spark.createDataFrame([(1, 301.0), (1, 300.0), (0, 400.0), (1, None), (0, 1.0)], "spike int, ev_max_rrp double")
    r = evaluate.evaluate_rule(df).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.n, r.precision, r.recall, r.accuracy) == (1, 1, 1, 1, 5, 0.5, 0.5, 0.4)
    none = evaluate.evaluate_rule(df.where("ev_max_rrp < 2")).first()
    assert none.precision is None and none.recall is None


def test_alignment_counts_match_a_real_join(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (2,), (4,)], "k int")
    r = quality.join_alignment(a, b, ["k"]).first()
    assert (r.left_rows, r.right_rows, r.joined_rows) == (4, 4, a.join(b, "k").count())
    assert (r.left_only, r.right_only, r.repeated_keys) == (1, 1, 1)


def test_storage_stats(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "t"))
    r = quality.storage_stats(spark.read.parquet(str(tmp_path / "t")), "t").first()
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert (r.table_name, r.n_rows, r.n_bytes, r.parts) == ("t", 100, size, 4)


def test_dictionary_covers_specs_and_features(spark):
    from tidemark.plans.features import feature_columns
    from tidemark.specs import SPECS
    words = catalog.dictionary(spark)
    assert words.count() == words.select("table_name", "column_name").distinct().count()
    for name, spec in SPECS.items():
        empty = spark.createDataFrame([], spec.schema)
        assert catalog.undocumented(catalog.schema_frame(empty, name), words).count() == 0
    mine = {r.column_name for r in words.where("table_name = 'features'").collect()}
    assert mine == set(feature_columns())


def test_wildcard_entry_gives_way_to_the_table_s_own(spark):
    words = spark.createDataFrame([("*", "a", "meta", "", "shared"), ("t", "a", "key", "", "own"), ("*", "b", "meta", "", "shared")],
                                  catalog.SCHEMA)
    cols = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "c")], "table_name string, column_name string")
    got = {r.column_name: r.description for r in catalog.describe_columns(cols, words).collect()}
    assert got == {"a": "own", "b": "shared", "c": None}
    assert [r.column_name for r in catalog.undocumented(cols, words).collect()] == ["c"]


def test_dictionary_order(spark):
    words = catalog.dictionary(spark).where("table_name = 'features'")
    names = [r.column_name for r in catalog.sorted_entries(words).collect()]
    assert names[:4] == ["regionid", "trading_day", "spike", "actual_max_rrp"] and len(names) == 41


def test_reference_document(spark, tmp_path):
    import json
    doc = {"regions": [
        {"id": "R1", "demand": 3.0, "mix": {"wind": 60.0, "gas": 40.0}, "cities": [{"name": "A", "population": 9}, {"name": "B", "population": 2}]},
        {"id": "R2", "demand": 1.0, "mix": {"wind": 20.0, "coal": 80.0}, "cities": []}]}
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=2))
    from tidemark.sources import tables
    docs = tables.reference_documents(spark, str(tmp_path), "regions array<struct<id:string,demand:double,mix:map<string,double>,"
                                      "cities:array<struct<name:string,population:bigint>>>>").select(F.inline("regions"))
    cities = reshape.explode_ranked(docs, ["id"], "cities").collect()
    assert [(r.id, r["rank"], r.name) for r in cities] == [("R1", 1, "A"), ("R1", 2, "B")]
    long = reshape.melt_map(docs, ["id"], "mix")
    mix = {r.key: r.pct for r in reshape.weighted_average(long, docs, "id", "demand").collect()}
    assert mix == pytest.approx({"wind": 50.0, "gas": 30.0, "coal": 20.0})
    wide = {r.id: (r.wind, r.coal) for r in reshape.pivot_wide(long, "id", ["wind", "coal"]).collect()}
    assert wide == {"R1": (60.0, None), "R2": (20.0, 80.0)}
    shares = reshape.share_table(long.where("id = 'R1'"), "key", "Fuel").collect()
    assert [(r.Fuel, r.share) for r in shares] == [("wind", 60.0), ("gas", 40.0)]


def test_profile_matches_duckdb(spark):
    from checks import base
    df = base.table(spark, "/root/testdata/sf0.001", "events")
    got = {r.column_name: (r.n_rows, r.n_null, r.n_distinct) for r in quality.profile_columns(df).collect()}
    con = duckdb.connect()
    for c in df.columns:
        want = con.execute(f"SELECT count(*), count(*) - count({c}), count(DISTINCT {c}) FROM "
                           "'/root/testdata/sf0.001/events.parquet'").fetchone()
        assert got[c] == want


def test_estimated_profile(spark):
    df = spark.range(50).select("id", F.when(F.col("id") > 9, 1).alias("v"))
    got = {r.column_name: (r.n_rows, r.n_null, r.n_distinct, r.dtype) for r in quality.profile_columns(df, exact=False).collect()}
    assert got["v"] == (50, 10, 1, "int") and got["id"][:2] == (50, 0) and 45 <= got["id"][2] <= 55


def test_empty_table_still_lists_its_columns(spark):
    got = quality.profile_columns(spark.createDataFrame([], "a int, b string")).collect()
    assert {tuple(r) for r in got} == {("a", 0, 0, 0, "int"), ("b", 0, 0, 0, "string")}


def test_sketches_of_parts_merge_into_the_profile_of_the_whole(spark):
    """Nulls, NaN, text and a group of nulls only; merging in any grouping gives one result."""
    from tidemark.operators import sketches
    df = spark.range(9000).select(
        (F.col("id") % 7).alias("part"), F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 7 == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("w"), F.col("id") % 100)).alias("word"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.0).alias("odd"))
    parts = sketches.sketch(df, ["part"])
    assert parts.count() == 21
    once = {r.column_name: r for r in sketches.estimated(sketches.merged(parts), [0.1, 0.9]).collect()}
    twice = sketches.merged(sketches.merged(parts.withColumn("half", F.col("part") % 2), ["half"]))
    again = {r.column_name: r for r in sketches.estimated(twice, [0.1, 0.9]).collect()}
    assert {c: (r.n_rows, r.n_null, r.low, r.high, r.n_distinct) for c, r in once.items()} == {
        c: (r.n_rows, r.n_null, r.low, r.high, r.n_distinct) for c, r in again.items()}
    x, word = once["x"], once["word"]
    assert (x.n_rows, x.n_null, x.low, x.high) == (9000, 1800, 1.0, 8999.0) and abs(x.n_distinct - 7200) < 500
    assert abs(x.quantiles[0] - 900) < 270 and abs(x.quantiles[1] - 8100) < 270
    assert word.quantiles is None and word.low is None and abs(word.n_distinct - 100) <= 3
    assert once["odd"].low == 1.0 and once["odd"].n_null == 0
    assert sketches.estimated(sketches.merged(sketches.sketch(df.limit(0), ["part"]))).count() == 0
