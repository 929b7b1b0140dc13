"""Physical plans: what is scanned, what is pushed down, where Python runs."""

import re

import pytest
from pyspark.sql import functions as F

from checks import ORACLE, QUERIES, base
from tidemark.functions import timeaxis
from tidemark.operators import asof, clean, merge
from tidemark.session import shared_folder
from tidemark.specs import SPECS

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_scan_reads_only_needed_columns(spark):
    assert read_columns(plan_of(QUERIES["scan_pruned"](spark, SF))) == [{"ts", "user_id", "value"}]


def test_trading_days_prune_partitions_and_row_groups(spark):
    spec = SPECS["dispatchprice"]
    path = shared_folder(spark, "plan")
    merge.write_partitioned(base.a_price(spark, SF), spec, path)
    df = timeaxis.trading_days(spark.read.schema(spec.stored_schema).parquet(path), "settlementdate", "2024-01-05", "2024-01-06")
    text = plan_of(df.select("rrp"))
    assert re.search(r"PartitionFilters: \[.*year", text) and "GreaterThanOrEqual(settlementdate" in text


def test_one_pass_for_all_cutoffs(spark):
    """Two snapshots scan and join the forecasts once, and nothing joins the snapshots."""
    df = asof.snapshots(base.forecast(spark, SF), {"fc": 13, "ev": 20}, 1)
    text = plan_of(df)
    assert len(read_columns(text)) == 2  # forecast price and forecast state
    assert text.count("Join") == 1 and "Window" not in text


def test_as_of_combines_before_the_shuffle(spark):
    text = plan_of(asof.forecast_asof(base.forecast(spark, SF), {"ev": 20}, ["rrp"]))
    assert "partial_max_by" in text and "Window" not in text


def test_finalise_combines_before_the_shuffle(spark):
    assert "partial_min_by" in plan_of(clean.price_final(base.a_price(spark, SF), ["event_id"]))


# Bytes are unzipped in Python, and packed in Python to make the fixture.
PYTHON = {"archive_unpack", "stream_ingest"}


@pytest.mark.parametrize("name", [n for n in ORACLE if not n.startswith(("stream_", "merge_partition"))])
def test_no_python_and_no_cross_join(spark, name):
    text = plan_of(QUERIES[name](spark, SF))
    if name not in PYTHON:
        assert not re.search(r"Python|MapInPandas|MapInArrow", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_merge_looks_only_where_the_batch_is(spark):
    spec = SPECS["dispatchprice"]
    path = shared_folder(spark, "plan")
    merge.write_partitioned(base.a_price(spark, SF), spec, path)
    batch = base.a_price(spark, SF).where(F.col("settlementdate") > F.lit("2024-01-20").cast("timestamp_ntz"))
    new, _ = merge.plan_merge(spark, path, batch, spec, [F.col("event_id")])
    assert re.search(r"PartitionFilters: \[.*year", plan_of(new)) and "GreaterThanOrEqual(settlementdate" in plan_of(new)
    assert new.count() == 0


def test_year_bound_follows_a_merge_window(spark):
    spec = SPECS["dispatchprice"]
    path = shared_folder(spark, "plan")
    merge.write_partitioned(base.a_price(spark, SF), spec, path)
    stored = spark.read.schema(spec.stored_schema).parquet(path)
    window = tuple(F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-07"))
    text = plan_of(merge.missing(stored, base.a_price(spark, SF), list(spec.key), spec.time_col, window))
    assert re.search(r"PartitionFilters: \[.*year", text) and "LeftAnti" in text


@pytest.mark.parametrize("name", ["stored_forecast_join", "stored_asof"])
def test_stored_layout_needs_no_exchange(spark, name):
    """Joins of three stored tables, and the as-of selection, read buckets and shuffle nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(QUERIES[name](spark, SF))
        assert "Exchange" not in text and "Bucketed: true" in text and "Join" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_merge_plans_its_keys_once(spark):
    spec = SPECS["dispatchprice"]
    path = shared_folder(spark, "plan")
    merge.write_partitioned(base.a_price(spark, SF).where("event_id % 2 = 0"), spec, path)
    batch = base.a_price(spark, SF)
    text = plan_of(merge.plan_once(spark, path, batch, spec, [F.col("event_id")]))
    assert text.count("Join") == 1 and "partial_min_by" in text
    done = merge.merge_into(spark, path, batch, spec, [F.col("event_id")])
    keys = batch.select(*spec.key).distinct().count()
    assert done.pulled == batch.count() == done.appended + done.duplicates + done.already_held
    assert spark.read.parquet(path).select(*spec.key).distinct().count() == keys
    again = merge.merge_into(spark, path, batch, spec, [F.col("event_id")])
    assert (again.appended, again.duplicates, again.already_held) == (0, 0, again.pulled)


def test_as_of_rows_stay_in_the_order_of_their_join(spark):
    """The join of the forecasts leaves regions and intervals in order; the selection adds no sort before it combines."""
    text = plan_of(asof.snapshots(base.forecast(spark, SF), {"fc": 13, "ev": 20}, 1))
    below = text[text.index("partial_max_by"):]
    assert "Broadcast" not in text and below.index("SortMergeJoin") < below.index("Sort [")
    assert "make_dt_interval" not in text
