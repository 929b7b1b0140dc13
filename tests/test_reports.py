"""Report text and archives."""

import io
import zipfile

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidemark.functions import provenance
from tidemark.operators import clean
from tidemark.session import shared_folder
from tidemark.sources import files, reports, tables
from tidemark.specs import SPECS
from tidemark.streaming import jobs

HEAD = "I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,INTERVENTION,RRP,PRICE_STATUS"
OTHER = "I,DISPATCH,PRICE,5,REGIONID,RRP,SETTLEMENTDATE,INTERVENTION"
STATE = "I,DISPATCH,REGIONSUM,4,SETTLEMENTDATE,REGIONID,INTERVENTION,TOTALDEMAND"


def row(t="2024/08/01 00:05:00", region="NSW1", rrp="10.5", status="FIRM"):
    return f'D,DISPATCH,PRICE,5,"{t}",1,{region},0,{rrp},{status}'


def lines_of(spark, text, name="PUBLIC_X_202409010005_20240901000400.zip"):
    return spark.createDataFrame([("p/" + name, "", name, 0, i, line) for i, line in enumerate(text.split("\n"))],
                                 reports.LINES)


def prices(spark, text, **kw):
    return reports.parse_reports(lines_of(spark, text), ["dispatchprice"], **kw)["dispatchprice"].collect()


def test_two_tables_and_footer(spark):
    text = "\n".join(["C,made up", HEAD, row(), row(region="SA1"), STATE, 'D,DISPATCH,REGIONSUM,4,"2024/08/01 00:05:00",SA1,0,99',
                      "F,END"])
    out = reports.parse_reports(lines_of(spark, text))
    assert {(r.regionid, r.rrp, r.settlementdate, r.published) for r in out["dispatchprice"].collect()} == {
        (g, 10.5, ts("2024-08-01T00:05:00"), ts("2024-09-01T00:04:00")) for g in ("NSW1", "SA1")}
    assert [r.totaldemand for r in out["dispatchregionsum"].collect()] == [99.0]
    assert out["predispatchprice"].count() == 0


def test_quotes_commas_and_missing_values(spark):
    text = "\n".join([HEAD, row(status='"FIRM, ""almost"""'), row(rrp="")])
    got = prices(spark, text)
    assert {(r.price_status, r.rrp) for r in got} == {('FIRM, "almost"', 10.5), ("FIRM", None)}


def test_rows_before_a_header_are_ignored(spark):
    assert len(prices(spark, "\n".join([row(), HEAD, row(region="SA1")]))) == 1


def test_repeated_header_unites_or_replaces(spark):
    text = "\n".join([HEAD, row(), STATE, HEAD, row(region="SA1")])
    assert {r.regionid for r in prices(spark, text)} == {"NSW1", "SA1"}
    assert {r.regionid for r in prices(spark, text, repeated="last")} == {"SA1"}
    flagged = reports.repeated_headers(lines_of(spark, text)).collect()
    assert [(r.label, r.headers, r.layouts) for r in flagged] == [("DISPATCHPRICE", 2, 1)]


def test_columns_that_change_inside_a_file(spark):
    text = "\n".join([HEAD, row(), OTHER, 'D,DISPATCH,PRICE,5,SA1,77,"2024/08/01 00:05:00",0'])
    assert {(r.regionid, r.rrp) for r in prices(spark, text)} == {("NSW1", 10.5), ("SA1", 77.0)}
    assert {(r.regionid, r.rrp) for r in prices(spark, text, repeated="last")} == {("SA1", 77.0)}


def test_report_alias(spark):
    text = ("I,PREDISPATCH,REGION_PRICES,2,DATETIME,REGIONID,INTERVENTION,RRP,PREDISPATCHSEQNO\n"
            'D,PREDISPATCH,REGION_PRICES,2,"2024/08/01 00:30:00",SA1,0,5,2024080101')
    got = reports.ingest(lines_of(spark, text), SPECS["predispatchprice"]).first()
    assert (got.rrp, got.vintage, got.source) == (5.0, "2024080101", "report_archive")


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


@pytest.fixture
def landing(tmp_path):
    text = "\n".join([HEAD, row()]).encode()
    sa = "\n".join([HEAD, row(region="SA1")]).encode()
    vic = "\n".join([HEAD, row(region="VIC1")]).encode()
    bundle = zipped({
        "PUBLIC_X_202408010005_20240801000312.zip": zipped({"a.CSV": text}),
        "PUBLIC_X_202408010010_0000000012345678.zip": zipped({"b.csv": sa}),
        "readme.md": b"not a table", "plain.csv": vic})
    (tmp_path / "PUBLIC_X_20240801.zip").write_bytes(bundle)
    return tmp_path


def test_nested_archive_takes_innermost_time(spark, landing):
    rows = reports.ingest(reports.unpack(reports.read_archives(spark, str(landing))), SPECS["dispatchprice"])
    got = {r.regionid: (r.known_at, r.source_file) for r in rows.collect()}
    assert got == {"NSW1": (ts("2024-08-01T00:03:12"), "PUBLIC_X_20240801.zip"),
                   "SA1": (ts("2024-08-01T00:10:00"), "PUBLIC_X_20240801.zip"),
                   "VIC1": (ts("2024-08-01T00:00:00"), "PUBLIC_X_20240801.zip")}  # no stamp inside: the file's own


def test_text_files_split_into_many_tasks(spark, tmp_path):
    body = [HEAD] + [row(rrp=str(i)) for i in range(4000)] + [STATE] + [
        f'D,DISPATCH,REGIONSUM,4,"2024/08/01 00:05:00",SA1,0,{i}' for i in range(1000)]
    (tmp_path / "PUBLIC_X_202408010005_20240801000312.csv").write_text("\n".join(body))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = reports.read_text(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        out = reports.parse_reports(lines)
        assert out["dispatchprice"].select("rrp").distinct().count() == 4000
        assert out["dispatchregionsum"].count() == 1000
        last = reports.parse_reports(lines, ["dispatchprice"], repeated="last")["dispatchprice"]
        assert last.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_streamed_archives_are_taken_once(spark, landing):
    root = shared_folder(spark, "ingest")
    for _ in range(2):
        stream = jobs.landed_archives(spark, str(landing))
        jobs.finish(jobs.stream_ingest(stream, f"{root}/t", SPECS["dispatchprice"], f"{root}/cp"))
    assert spark.read.parquet(f"{root}/t").count() == 3


def test_publication_time_is_never_early(spark):
    names = ["PUBLIC_PREDISPATCHIS_202609092330_20260909230155.zip", "PUBLIC_DISPATCHIS_202609092210_0000000536970282.zip",
             "PUBLIC_DISPATCHIS_20260919.zip", "x_20260909230155.CSV", "notes.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [tuple(r) for r in df.select(provenance.publication_time(F.col("name")), provenance.file_datetime(F.col("name"))).collect()]
    assert got == [(ts("2026-09-09T23:01:55"), ts("2026-09-09T23:30:00")), (ts("2026-09-09T22:10:00"),) * 2,
                   (None, ts("2026-09-19T00:00:00")), (ts("2026-09-09T23:01:55"), ts("2026-09-09T00:00:00")), (None, None)]


def test_selection_is_half_open_and_skips_seen(spark):
    df = spark.createDataFrame([("Reports/Current/a", f"X_2024010{d}0000_1.zip") for d in (1, 2, 3)], "path string, name string")
    lo, hi = (F.lit(f"2024-01-0{d}").cast("timestamp_ntz") for d in (1, 3))
    picked = files.select_files(df, lo, hi)
    assert [(r.name[2:10], r.tier) for r in picked.collect()] == [("20240101", "report_current"), ("20240102", "report_current")]
    seen = spark.createDataFrame([("X_202401010000_1.zip",), (None,)], "source_file string")
    assert files.skip_seen(picked, files.stored_files(seen)).count() == 1


def test_tidy_bad_values(spark):
    df = spark.createDataFrame([("2024/08/01 00:05:00", "SA1", "0", "1.5"), ("soon", "SA1", "x", "y"), ("2024-08-01T00:05:00", "WA1", "0", "1")],
                               "SETTLEMENTDATE string, REGIONID string, INTERVENTION string, RRP string")
    got = [(r.settlementdate, r.intervention, r.rrp) for r in clean.tidy(df, SPECS["dispatchprice"]).collect()]
    assert got == [(ts("2024-08-01T00:05:00"), 0, 1.5), (None, None, None)]


def test_absent_folder_is_empty_and_drift_is_reported(spark, tmp_path):
    schema = SPECS["dispatchprice"].schema
    assert tables.scan_or_empty(spark, str(tmp_path / "none"), schema).count() == 0
    drift = tables.schema_drift(spark.createDataFrame([(1, "x")], "rrp int, surprise string"), schema)
    assert drift["extra"] == ["surprise"] and drift["retyped"] == ["rrp"] and "regionid" in drift["missing"]


def test_json_rows_ignore_unknown_fields_and_bad_dates(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([('{"a":1,"t":"2024-01-01T00:05:00","zz":3}',), ('{"a":2,"t":"never"}',)], "value string")
    got = [tuple(r) for r in tables.json_rows(df, T.StructType.fromDDL("a int, t timestamp_ntz")).collect()]
    assert got == [(1, ts("2024-01-01T00:05:00")), (2, None)]


def one_report(text, name="PUBLIC_X_202409010005_20240901000400.CSV"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, text)
    return out.getvalue()


def test_a_broken_archive_is_reported_and_the_rest_read(spark):
    good = one_report("\n".join([HEAD, row(), row(region="SA1")]))
    spoiled = bytearray(good)
    spoiled[60] ^= 255
    df = spark.createDataFrame([("a.zip", good), ("b.zip", b"not a zip"), ("c.zip", bytes(spoiled)), ("d.zip", good)],
                               "path string, content binary")
    lines = reports.stored_lines(reports.unpack(df), shared_folder(spark, "lines"))
    assert {r.path for r in reports.failures(lines).collect()} == {"b.zip", "c.zip"}
    got = reports.parse_reports(lines, ["dispatchprice"])["dispatchprice"]
    assert {r.path for r in got.collect()} >= {"a.zip", "d.zip"} and got.where("path = 'd.zip'").count() == 2


def test_workers_need_no_copy_of_the_package(spark, tmp_path):
    """A driver started elsewhere, with the package on its own path only."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "a.zip").write_bytes(one_report("\n".join([HEAD, row()])))
    script = (f"import sys; sys.path.insert(0, {root!r})\n"
              "from tidemark.session import build_session\nfrom tidemark.sources import reports\n"
              "spark = build_session('elsewhere', 'local[1]', **{'spark.ui.enabled': 'false'})\n"
              "import os; os.chdir('/')\n"
              f"print('rows', reports.unpack(reports.read_archives(spark, {str(tmp_path)!r})).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 2" in out.stdout, out.stderr[-2000:]


def test_files_of_a_window_are_opened_once(spark, tmp_path):
    from tidemark.plans import ingest
    for k in range(4):
        (tmp_path / f"PUBLIC_DISPATCHIS_20240901000{k}_1.zip").write_bytes(
            one_report("\n".join([HEAD, row(rrp=str(k)), row(region="SA1", rrp=str(k))])))
    (tmp_path / "PUBLIC_DISPATCHIS_202409010009_1.zip").write_bytes(b"broken")
    root = shared_folder(spark, "daily")
    stores = {"dispatchprice": f"{root}/price"}
    lo, mid, hi = (F.lit(t).cast("timestamp_ntz") for t in ("2024-09-01 00:00:00", "2024-09-01 00:02:00", "2024-09-01 00:10:00"))

    def run(a, b, batch):
        listing, read = ingest.folder_source(spark, str(tmp_path))
        return ingest.ingest_window(spark, listing, read, stores, a, b, f"{root}/log", batch, root)

    first = run(lo, mid, "1")
    assert (first.opened, first.broken, first.status) == (2, {}, {"dispatchprice": "success"})
    second = run(lo, hi, "2")  # two of five are stored; the broken one is tried and reported
    assert second.opened == 3 and [k.rsplit("/", 1)[1] for k in second.broken] == ["PUBLIC_DISPATCHIS_202409010009_1.zip"]
    assert spark.read.parquet(f"{root}/price").count() == 2


def test_lines_without_quotes_are_split_at_commas(spark):
    """Their fields are those of the pattern, also where fields are empty; labels are told from the start of a line."""
    lines = ["D,A,B,1,x", "D,A,B,,", ",a", "", "D", "D,A,B,1,\"x,y\"\"z\",2", "D,\"A\",\"B,C\",1,q,", "D,A,\"", "I, a ,b ,é,"]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "k int, t string").coalesce(1).orderBy("k").select(
        reports.fields(F.col("t"))).collect()]
    want = [t.split(",") if '"' not in t and t[:1] != "," else None for t in lines]
    assert [g for g, w in zip(got, want) if w is not None] == [w for w in want if w is not None]
    assert got[5] == ["D", "A", "B", "1", 'x,y"z', "2"] and got[6] == ["D", "A", "B,C", "1", "q", ""]
    heads, rows = reports._split_rows(spark.createDataFrame([("p", "m", "n", 0, k, t) for k, t in enumerate(lines)], reports.LINES))
    assert sorted(r.label for r in rows.collect() if r.label) == ["A", "AB", "AB", "AB", "AB,C"]
    plan = rows.where("label = 'AB'").select("label")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan
