"""Windows, stored work plans, monthly extracts, and what the trail says of files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ts
from test_reports import HEAD, one_report, row
from tidemark.operators import batchlog
from tidemark.plans import backfill, ingest
from tidemark.session import shared_folder
from tidemark.sources import tables
from tidemark.specs import SPECS


def lit(text):
    return F.lit(text).cast("timestamp_ntz")


def test_windows_cover_the_range_and_keep_equal_stamps_together(spark):
    names = [f"X_20240901000{k // 3}_{k}.zip" for k in range(12)] + ["X_202501010000_1.zip", "notes.txt"]
    listing = spark.createDataFrame([(f"Reports/Current/{n}", n) for n in names], "path string, name string")
    cut = ingest.windows(listing, lit("2024-09-01"), lit("2024-10-01"), 4)
    assert cut[0][0] == ts("2024-09-01T00:00:00") and cut[-1][1] == ts("2024-10-01T00:00:00")
    assert all(a[1] == b[0] for a, b in zip(cut, cut[1:])) and [c[2] for c in cut] == [6, 3, 3]
    assert ingest.windows(listing, lit("2023-01-01"), lit("2023-02-01"), 4) == []


def test_months_are_cut_to_the_range():
    d = dt.datetime
    assert backfill.months(d(2023, 11, 10), d(2024, 1, 20)) == [
        (d(2023, 11, 10), d(2023, 12, 1)), (d(2023, 12, 1), d(2024, 1, 1)), (d(2024, 1, 1), d(2024, 1, 20))]
    assert backfill.months(d(2024, 1, 20), d(2024, 1, 20)) == []


def test_final_forecasts_are_known_when_written_or_before_their_run(spark):
    df = spark.createDataFrame([("SA1", "2024/08/01 00:30:00", "2024080101", "2024/08/01 00:00:00", ts("2024-07-31T23:41:00")),
                                ("SA1", "2024/08/01 00:30:00", "2024080102", "2024/08/01 00:30:00", None),
                                ("XX1", "2024/08/01 00:30:00", "2024080102", "2024/08/01 00:30:00", None)],
                               "REGIONID string, DATETIME string, PREDISPATCHSEQNO string, PREDISPATCH_RUN_DATETIME string, RUN_WRITTEN_AT timestamp_ntz")
    df = df.withColumn("PREDISPATCH_RUN_DATETIME", F.to_timestamp_ntz("PREDISPATCH_RUN_DATETIME", F.lit("yyyy/MM/dd HH:mm:ss")))
    got = backfill.finals(df, SPECS["predispatchprice"]).collect()
    assert sorted((r.known_at, r.known_at_kind, r.source) for r in got) == [
        (ts("2024-07-31T23:41:00"), "estimated", "mmsdm"), (ts("2024-08-01T00:00:00"), "estimated", "mmsdm")]
    assert len({r.vintage for r in got}) == 2


@pytest.fixture
def folder(tmp_path):
    for k, region in enumerate(["SA1", "NSW1", "VIC1", "QLD1", "TAS1"]):
        (tmp_path / f"PUBLIC_DISPATCHIS_20240901000{k}_1.zip").write_bytes(one_report("\n".join([HEAD, row(rrp=str(k), region=region)])))
    (tmp_path / "PUBLIC_DISPATCHIS_202409010003_2.zip").write_bytes(b"broken")
    return tmp_path


def test_a_killed_range_goes_on_where_it_stopped(spark, folder):
    root = shared_folder(spark, "range")
    stores = {"dispatchprice": f"{root}/price"}
    opened = []

    def run(job, dies_at=None):
        listing, read = ingest.folder_source(spark, str(folder))

        def counted(paths):
            if len(opened) == dies_at:
                raise RuntimeError("killed")
            opened.append(len(paths))
            return read(paths)

        return ingest.ingest_range(spark, listing, counted, stores, lit("2024-09-01"), lit("2024-09-02"), f"{root}/log", job, root, most=2)

    with pytest.raises(RuntimeError, match="killed"):
        run("a", dies_at=1)
    assert spark.read.parquet(stores["dispatchprice"]).count() == 2
    total = run("a")
    assert opened == [2, 3, 1] and total.opened == 4 and len(total.broken) == 1
    assert run("a").opened == 0 and sum(opened) == 6
    assert run("b").opened == 1  # another job tries the broken file again and no other
    assert spark.read.parquet(stores["dispatchprice"]).select("regionid").distinct().count() == 5
    trail = batchlog.file_trail(spark, f"{root}/log").collect()
    assert {(r.batch, r.opened, r.failed) for r in trail} == {("a-000000", 2, 0), ("a-000001", 3, 1), ("a-000002", 1, 0), ("b-000001", 1, 1)}
    assert [r.path.rsplit("/", 1)[1] for r in trail if r.error] == ["PUBLIC_DISPATCHIS_202409010003_2.zip"] * 2
    thin = ingest.thin_days(spark, stores, {"dispatchprice": 1}, "2024-08-03", 2).collect()
    assert {(r.table_name, str(r.day), r.n_rows) for r in thin} == {("dispatchprice", "2024-08-02", 0)}


def test_rebuild_keeps_what_lies_before(spark):
    root = shared_folder(spark, "rebuild")
    spec = SPECS["dispatchprice"]

    def rows(days, rrp):
        return spark.createDataFrame([("SA1", ts(f"{d}T00:00:00"), 0, rrp, "mmsdm") for d in days],
                                     "regionid string, settlementdate timestamp_ntz, intervention int, rrp double, source string")

    from tidemark.operators import merge
    merge.write_partitioned(rows(["2022-06-01", "2023-03-01", "2023-09-01", "2024-01-01", "2025-01-01"], 1.0), spec, root)
    backfill.rebuild_from(spark, root, rows(["2023-02-01", "2023-10-01", "2024-02-01"], 2.0), spec, lit("2023-08-01"))
    got = {(str(r.settlementdate)[:10], r.rrp) for r in spark.read.parquet(root).collect()}
    assert got == {("2022-06-01", 1.0), ("2023-03-01", 1.0), ("2023-10-01", 2.0), ("2024-02-01", 2.0)}
    assert not [n for n in tables.children(spark, root) if n == "year=2025"]
