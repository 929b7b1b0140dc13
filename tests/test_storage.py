"""Merges, writes, paging and the batch log."""

import datetime as dt

from conftest import same_rows, ts
from pyspark.sql import functions as F

from checks import storage
from tidemark.operators import batchlog, layout, merge, serving
from tidemark.session import shared_folder
from tidemark.sources import tables
from tidemark.specs import SPECS

PRICE = SPECS["dispatchprice"]
KEY = list(PRICE.key)


def rows(spark, items):
    """items: (region, label, rrp, n); n orders arrival"""
    return spark.createDataFrame(
        [(r, ts(t), 0, "mmsdm", p, n, ts(t), f"f{n}", ts("2024-03-01")) for r, t, p, n in items],
        "regionid string, settlementdate timestamp_ntz, intervention int, source string, rrp double, n int, "
        "known_at timestamp_ntz, source_file string, ingested_at timestamp_ntz")


def stored(spark, path):
    return spark.read.schema(PRICE.stored_schema).parquet(path)


BATCH = [("SA1", "2023-12-31T23:55:00", 1.0, 1), ("SA1", "2024-01-01T00:00:00", 2.0, 2),
         ("SA1", "2024-01-01T00:00:00", 3.0, 3)]


def test_merge_twice_adds_nothing(spark):
    path = shared_folder(spark, "t")
    order = [F.col("n")]
    merge.merge_into(spark, path, rows(spark, BATCH), PRICE, order)
    assert {(r.rrp, r.year) for r in stored(spark, path).collect()} == {(1.0, 2023), (2.0, 2024)}
    changed = [(r, t, p + 100, n) for r, t, p, n in BATCH]
    merge.merge_into(spark, path, rows(spark, changed), PRICE, order)
    assert {r.rrp for r in stored(spark, path).collect()} == {1.0, 2.0}  # the stored value is kept
    assert merge.merge_new(stored(spark, path), rows(spark, BATCH), KEY, order).count() == 0


def test_merge_does_not_depend_on_row_order(spark):
    a, b = rows(spark, BATCH), rows(spark, BATCH[::-1])
    empty = tables.scan_or_empty(spark, shared_folder(spark, "none"), PRICE.schema)
    same_rows(merge.merge_new(empty, a, KEY, [F.col("n")]), merge.merge_new(empty, b, KEY, [F.col("n")]))


def test_dry_run_writes_nothing(spark):
    path = shared_folder(spark, "t")
    assert merge.merge_into(spark, path, rows(spark, BATCH), PRICE, [F.col("n")], dry_run=True).appended == 2
    assert tables.scan_or_empty(spark, path, PRICE.schema).count() == 0


def test_empty_batch_is_a_no_op(spark):
    path = shared_folder(spark, "t")
    merge.merge_into(spark, path, rows(spark, BATCH), PRICE, [F.col("n")])
    merge.merge_into(spark, path, rows(spark, BATCH).limit(0), PRICE, [F.col("n")])
    assert stored(spark, path).count() == 2


def test_revisions_are_kept_on_request(spark):
    old = rows(spark, BATCH[1:2])
    new = old.withColumn("ingested_at", F.lit("2024-03-02").cast("timestamp_ntz")).withColumn("rrp", F.lit(9.0))
    assert merge.merge_new(old, new, KEY, [F.col("n")]).count() == 0
    assert merge.merge_new(old, new, KEY, [F.col("n")], keep_revisions=True).count() == 1


def test_null_keys(spark):
    df = rows(spark, [(None, "2024-01-01T00:00:00", 1.0, 1), ("SA1", "2024-01-01T00:00:00", 1.0, 2)])
    assert merge.missing(df, df, KEY).count() == 1          # a null never matches, so it is inserted
    assert merge.merge_new(df, df, KEY, [F.col("n")]).count() == 0  # a warehouse merge treats nulls as equal
    counts = merge.merge_counts(df, df, KEY, null_safe=False).first()
    assert (counts.pulled, counts.already_held, counts.inserted) == (2, 1, 1)


def test_window_bounds_the_stored_side(spark):
    df = rows(spark, BATCH)
    late = tuple(F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01", "2024-01-02"))
    assert merge.held(df, df, KEY, "settlementdate", late).count() == 2


def test_layers_meet_at_the_cutoff(spark):
    df = rows(spark, BATCH[:2])
    cut = F.lit("2024-01-01").cast("timestamp_ntz")
    got = merge.layered(df, df.withColumn("rrp", F.lit(50.0)), "settlementdate", cut)
    assert sorted(r.rrp for r in got.collect()) == [1.0, 50.0]


def counts(r):
    return (r.pulled, r.appended, r.duplicates, r.already_held, r.status)


def test_batch_log_records_success_and_failure(spark):
    path, log = shared_folder(spark, "t"), shared_folder(spark, "log")
    window, order = ("2023-12-01", "2024-02-01"), [F.col("rrp")]
    batch = rows(spark, BATCH).drop("n")

    def broken():
        raise RuntimeError("feed is down" + "." * 5000)

    def one(job, load):
        return batchlog.merge_all(spark, log, job, [(PRICE, path, load, order)], window)[PRICE.name]

    assert one("b1", lambda: batch) == one("b2", lambda: batch) == "success"
    assert one("b3", broken) == "failed"
    got = {r.batch: r for r in batchlog.trail(spark, log).collect()}
    assert counts(got["b1"]) == (3, 2, 1, 0, "success") and counts(got["b2"]) == (3, 0, 0, 3, "success")
    assert counts(got["b3"]) == (0, 0, 0, 0, "failed") and len(got["b3"].message) == 5012
    assert one("b3", lambda: batch) == "success"  # a failed batch may be tried again
    import os
    assert not [f for f in os.listdir(os.path.dirname(path)) if f.startswith(os.path.basename(path) + "-stage")]


def test_a_crash_between_append_and_close_keeps_the_planned_counts(spark):
    path, log = shared_folder(spark, "t"), shared_folder(spark, "log")
    batch, order = rows(spark, BATCH).drop("n"), [F.col("rrp")]
    assert batchlog.merge_once(spark, log, "j", "1", path, PRICE, lambda: batch, order) == "success"
    tables.drop(spark, f"{log}/phase=closed/job=j/batch=1")
    assert [r.status for r in batchlog.trail(spark, log).collect()] == ["open"]
    for _ in range(2):
        assert batchlog.merge_once(spark, log, "j", "1", path, PRICE, lambda: batch, order) == "success"
        assert [counts(r) for r in batchlog.trail(spark, log).collect()] == [(3, 2, 1, 0, "success")]
    assert stored(spark, path).count() == 2


def test_pages_cover_the_range_once(spark):
    from checks import base
    df = base.a_price(spark, "/root/testdata/sf0.001").select("settlementdate", "regionid", "intervention", "source",
                                                              "event_id")
    all_rows = serving.range_read(df, PRICE, "2024-01-03", "2024-01-05")
    order = [*serving.page_order(PRICE), "event_id"]
    want = [r.event_id for r in all_rows.orderBy(*order).collect()]
    got, offset = [], 0
    while offset is not None:
        page = serving.page(all_rows, order, 7, offset).collect()
        got += [r.event_id for r in page]
        offset = serving.next_offset(len(page), offset, 7)
    assert got == want and len(want) > 21
    got, after = [], None
    while True:
        page = serving.page_after(all_rows, order, after, 7).collect()
        if not page:
            break
        got += [r.event_id for r in page]
        after = page[-1].asDict()
    assert got == want


def test_unknown_region_and_bad_range(spark):
    import pytest
    df = rows(spark, BATCH)
    assert serving.range_read(df, PRICE, "2023-01-01", "2025-01-01", "nowhere").count() == 0
    assert serving.range_read(df, PRICE, "2023-01-01", "2025-01-01", "sa1").count() == 3
    with pytest.raises(ValueError):
        serving.range_read(df, PRICE, "2024-01-01", "2024-01-01")


def test_json_rows_spell_out_nulls(spark):
    df = spark.createDataFrame([(ts("2024-01-01T00:05:00"), float("nan"), None)], "t timestamp_ntz, v double, s string")
    assert serving.to_json_rows(df).first().value == '{"t":"2024-01-01T00:05:00","v":null,"s":null}'


def test_sorted_load_clusters_keys(spark):
    path = shared_folder(spark, "t")
    items = [(r, f"2024-01-{d:02d}T00:00:00", 1.0, d) for d in range(1, 29) for r in ("SA1", "VIC1")]
    merge.write_sorted(rows(spark, items), PRICE, path)
    got = [(r.regionid, r.settlementdate) for r in spark.read.parquet(path).coalesce(1).collect()]
    assert len(got) == 56 and dt.datetime(2024, 1, 1) in {t for _, t in got}
    per_file = spark.read.parquet(path).select("regionid", "settlementdate", F.col("_metadata.file_path").alias("f")) \
        .withColumn("i", F.monotonically_increasing_id()).collect()
    for f in {r.f for r in per_file}:
        mine = [(r.regionid, r.settlementdate) for r in sorted(per_file, key=lambda r: r.i) if r.f == f]
        assert mine == sorted(mine)


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    """A bucket is one task of every join over the stored tables; it holds a bounded number of rows."""
    monkeypatch.setattr(storage, "PER_BUCKET", 1000)
    tables = storage.stored_in_buckets(spark, "/root/testdata/sf0.01")
    n = -(-tables["fc_price"].count() // 1000)
    assert n > storage.BUCKETS and len(tables["fc_price"].inputFiles()) == n
    assert layout.buckets_for(5, 1000, 16) == 16
