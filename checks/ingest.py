"""File names, report text, archives, typing and provenance."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import base
from checks.base import query
from tidemark.functions import provenance, timeaxis
from tidemark.operators import clean, merge
from tidemark.session import shared_folder
from tidemark.operators import batchlog
from tidemark.plans import backfill, ingest
from tidemark.sources import files, reports, tables
from tidemark.specs import SPECS

PRICE = SPECS["dispatchprice"]

# ------------------------------------------------------------------ file names made from events


def named_files(spark, sf) -> DataFrame:
    """One report file name per event, in each of the four naming schemes in turn."""
    stamp = F.date_format("settlementdate", "yyyyMMddHHmm")
    name = (F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("PUBLIC_PREDISPATCHIS_"), stamp, F.lit("_"),
                                                        F.date_format("ts", "yyyyMMddHHmmss"), F.lit(".zip")))
            .when(F.col("event_id") % 4 == 1, F.concat(F.lit("PUBLIC_DISPATCHIS_"), stamp, F.lit("_"),
                                                       F.lpad(F.col("event_id").cast("string"), 16, "0"), F.lit(".zip")))
            .when(F.col("event_id") % 4 == 2, F.concat(F.lit("PUBLIC_DISPATCHIS_"), F.date_format("settlementdate", "yyyyMMdd"),
                                                       F.lit(".zip")))
            .otherwise(F.lit("notes.csv")))
    folder = F.when(F.col("event_type") == "click", "Reports/Current/IS/").otherwise("Reports/Archive/IS/")
    return base.a_price(spark, sf).withColumn("name", name).withColumn("path", F.concat(folder, F.col("name")))


PUBLISHED = """CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN settlementdate END"""
FILE_TS = """CASE event_id % 4 WHEN 0 THEN settlementdate WHEN 1 THEN settlementdate
             WHEN 2 THEN settlementdate::DATE::TIMESTAMP END"""


@query("publication_time", f"SELECT event_id, {PUBLISHED} AS published FROM a_price")
def _(spark, sf):
    return named_files(spark, sf).select("event_id", provenance.publication_time(F.col("name")).alias("published"))


@query("file_datetime", f"SELECT event_id, {FILE_TS} AS file_ts FROM a_price")
def _(spark, sf):
    return named_files(spark, sf).select("event_id", provenance.file_datetime(F.col("name")).alias("file_ts"))


@query("known_at_report", f"SELECT event_id, coalesce({PUBLISHED}, {FILE_TS}) AS known_at FROM a_price")
def _(spark, sf):
    n = F.col("name")
    return named_files(spark, sf).select("event_id", provenance.known_at_report(
        provenance.publication_time(n), provenance.file_datetime(n)).alias("known_at"))


@query("select_files", f"""
    SELECT event_id, {FILE_TS} AS file_ts,
      CASE WHEN event_type = 'click' THEN 'report_current' ELSE 'report_archive' END AS tier
    FROM a_price WHERE ({FILE_TS}) >= TIMESTAMP '2024-01-05' AND ({FILE_TS}) < TIMESTAMP '2024-01-09'""")
def _(spark, sf):
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-09"))
    return files.select_files(named_files(spark, sf), lo, hi).select("event_id", "file_ts", "tier")


@query("skip_seen_files", """
    SELECT DISTINCT source_file AS name FROM a_price
    WHERE source_file NOT IN (SELECT source_file FROM a_price WHERE source = 'mmsdm')""")
def _(spark, sf):
    p = base.a_price(spark, sf)
    listed = p.select(F.col("source_file").alias("name")).distinct()
    return files.skip_seen(listed, files.stored_files(p.where(F.col("source") == "mmsdm")))


@query("seen_manifest", """
    SELECT DISTINCT t.table_name, p.source_file AS name FROM a_price p
    CROSS JOIN (SELECT unnest(['dispatchprice', 'dispatchregionsum']) AS table_name) t
    WHERE NOT EXISTS (SELECT 1 FROM a_price s WHERE s.source_file = p.source_file
      AND s.source = CASE t.table_name WHEN 'dispatchprice' THEN 'mmsdm' ELSE 'report_archive' END)""")
def _(spark, sf):
    """Each table is missing the files it has not stored, whatever its sibling holds."""
    p = base.a_price(spark, sf)
    stored = {"dispatchprice": p.where(F.col("source") == "mmsdm"),
              "dispatchregionsum": p.where(F.col("source") == "report_archive")}
    listed = p.select(F.col("source_file").alias("name")).distinct()
    wanted = tables.union_all([listed.select(F.lit(t).alias("table_name"), "name") for t in stored])
    return files.skip_seen(wanted, files.seen_manifest(stored))


LABELS = {"view": "PREDISPATCHREGION_PRICES", "click": "PREDISPATCHREGION_SOLUTION", "error": "DISPATCHPRICE"}


@query("alias_tables", """
    SELECT CASE event_type WHEN 'view' THEN 'PREDISPATCHPRICE' WHEN 'click' THEN 'PREDISPATCHREGIONSUM'
      WHEN 'error' THEN 'DISPATCHPRICE' ELSE 'DISPATCHREGIONSUM' END AS table_name, count(*) AS n
    FROM events GROUP BY 1""")
def _(spark, sf):
    label = F.lit("DISPATCHREGIONSUM")
    for event, report in LABELS.items():
        label = F.when(F.col("event_type") == event, report).otherwise(label)
    return (base.events(spark, sf).groupBy(files.warehouse_table(label).alias("table_name"))
            .agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ report text made from events

PER_FILE = 200


def report_lines(spark, sf) -> DataFrame:
    """Report text of both actual tables: a file per 200 events, tables one after the other."""
    t = F.concat(F.lit('"'), F.date_format("settlementdate", "yyyy/MM/dd HH:mm:ss"), F.lit('"'))
    run = F.date_format("settlementdate", "yyyyMMddHHmm")
    both = base.a_price(spark, sf).join(
        base.a_state(spark, sf).select("event_id", "totaldemand", "availablegeneration", "uigf"), "event_id")
    number = (F.col("event_id") / PER_FILE).cast("bigint")
    row = F.col("event_id") % PER_FILE
    keys = [F.concat(F.lit("landing/Reports/Current/PUBLIC_IS_"), number.cast("string"), F.lit(".zip")).alias("path"),
            F.lit("").alias("member"), F.lit("").alias("name"), F.lit(0).cast("bigint").alias("chunk")]
    price = F.concat_ws(",", F.lit("D,DISPATCH,PRICE,5"), t, F.lit("1"), F.col("regionid"),
                        F.col("intervention").cast("string"), F.col("rrp").cast("string"), F.col("price_status"))
    state = F.concat_ws(",", F.lit("D,DISPATCH,REGIONSUM,4"), F.col("regionid"), t, F.col("intervention").cast("string"),
                        F.col("totaldemand").cast("string"), F.lit(""), F.col("uigf").cast("string"),
                        F.col("availablegeneration").cast("string"))
    data = both.select(*keys, F.explode(F.array(
        F.struct((row + 2).alias("line"), price.alias("text")),
        F.struct((row + PER_FILE + 3).alias("line"), state.alias("text")))).alias("l")).select(
        "path", "member", "name", "chunk", "l.*")
    fixed = [(0, "C,MADE UP,REPORT"),
             (1, "I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,INTERVENTION,RRP,PRICE_STATUS"),
             (PER_FILE + 2, "I,DISPATCH,REGIONSUM,4,REGIONID,SETTLEMENTDATE,INTERVENTION,TOTALDEMAND,AVAILABLELOAD,UIGF,"
                            "AVAILABLEGENERATION"),
             (2 * PER_FILE + 3, "F,END OF REPORT")]
    heads = both.select(*keys).distinct().select("*", F.explode(F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("line"), F.lit(text).alias("text")) for n, text in fixed])).alias("l")).select(
        "path", "member", "name", "chunk", "l.*")
    return data.unionByName(heads)


@query("report_parse", """
    SELECT 'landing/Reports/Current/PUBLIC_IS_' || (event_id // 200)::VARCHAR || '.zip' AS path, regionid,
      settlementdate, intervention, rrp, price_status FROM a_price""")
def _(spark, sf):
    parsed = reports.parse_reports(report_lines(spark, sf), ["dispatchprice"])["dispatchprice"]
    return parsed.select("path", "regionid", "settlementdate", "intervention", "rrp", "price_status")


@query("report_parse_state", """
    SELECT regionid, settlementdate, intervention, totaldemand, availablegeneration, uigf,
      NULL::DOUBLE AS availableload FROM a_state""")
def _(spark, sf):
    parsed = reports.parse_reports(report_lines(spark, sf), ["dispatchregionsum"])["dispatchregionsum"]
    return parsed.select("regionid", "settlementdate", "intervention", "totaldemand", "availablegeneration", "uigf",
                         "availableload")


def archives(spark, sf) -> DataFrame:
    """A day bundle per report file: a zip holding one zip whose name gives the publication time."""
    def bundle(texts: pd.Series, names: pd.Series) -> pd.Series:
        def one(text: str, name: str) -> bytes:
            inner, outer = io.BytesIO(), io.BytesIO()
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("report.CSV", text)
            with zipfile.ZipFile(outer, "w") as z:
                z.writestr(name, inner.getvalue())
            return outer.getvalue()
        return pd.Series([one(t, n) for t, n in zip(texts, names)])

    pack = F.pandas_udf(bundle, T.BinaryType())
    lines = report_lines(spark, sf)
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda l: l["text"]))
    whole = lines.groupBy("path").agg(text.alias("body"))  # at most 404 lines each
    number = F.regexp_extract("path", r"_(\d+)\.zip$", 1).cast("bigint")
    when = F.lit("2024-02-01").cast("timestamp_ntz") + F.make_dt_interval(secs=number.cast("decimal(18,6)"))
    inner = F.concat(F.lit("PUBLIC_DISPATCHIS_202402010000_"), F.date_format(when, "yyyyMMddHHmmss"), F.lit(".zip"))
    return whole.select("path", pack("body", inner).alias("content"))


@query("archive_unpack", """
    SELECT regionid, settlementdate, intervention, rrp, 'report_current' AS source, 'file_timestamp' AS known_at_kind,
      TIMESTAMP '2024-02-01' + INTERVAL 1 SECOND * (event_id // 200) AS known_at,
      'PUBLIC_IS_' || (event_id // 200)::VARCHAR || '.zip' AS source_file FROM a_price""")
def _(spark, sf):
    lines = reports.stored_lines(reports.unpack(archives(spark, sf)), shared_folder(spark, "lines"))
    rows = reports.ingest(lines, SPECS["dispatchprice"])
    return rows.select("regionid", "settlementdate", "intervention", "rrp", "source", "known_at_kind", "known_at",
                       "source_file")


# ------------------------------------------------------------------ typing and provenance

@query("tidy", """
    SELECT CASE WHEN event_id % 17 <> 0 THEN settlementdate END AS settlementdate, regionid,
      CASE WHEN event_id % 19 <> 0 THEN intervention END AS intervention, rrp
    FROM a_price WHERE event_id % 23 <> 0""")
def _(spark, sf):
    e = F.col("event_id")
    raw = base.a_price(spark, sf).select(
        F.when(e % 17 == 0, "not a time").otherwise(F.date_format("settlementdate", "yyyy/MM/dd HH:mm:ss"))
        .alias("SETTLEMENTDATE"),
        F.when(e % 23 == 0, "ELSEWHERE").otherwise(F.col("regionid")).alias("REGIONID"),
        F.when(e % 19 == 0, "x").otherwise(F.col("intervention").cast("string")).alias("INTERVENTION"),
        F.col("rrp").alias("RRP"), F.lit(1).alias("RUNNO"))
    return clean.tidy(raw, SPECS["dispatchprice"])


@query("stamp", """
    SELECT event_id, 'mmsdm' AS source, ts + INTERVAL 5 MINUTE AS known_at, 'estimated' AS known_at_kind,
      TIMESTAMP '2024-03-01' AS ingested_at, source_file FROM a_price""")
def _(spark, sf):
    rows = base.a_price(spark, sf).select("event_id", "ts", "source_file")
    return provenance.stamp(rows, F.lit("mmsdm"), provenance.known_at_final(F.col("ts")), "estimated",
                            F.col("source_file"), F.lit("2024-03-01").cast("timestamp_ntz")).drop("ts")


@query("known_at_final", "SELECT event_id, settlementdate + INTERVAL 5 MINUTE AS known_at FROM a_price")
def _(spark, sf):
    return base.a_price(spark, sf).select(
        "event_id", provenance.known_at_final(F.col("settlementdate")).alias("known_at"))


@query("known_at_run", """
    SELECT event_id, v, coalesce(lastchanged, run_datetime - INTERVAL 30 MINUTE) AS known_at FROM a_fc_price""")
def _(spark, sf):
    return base.a_fc_price(spark, sf).select("event_id", "v", provenance.known_at_run(
        F.col("lastchanged"), F.col("run_datetime")).alias("known_at"))


@query("vintage", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(settlementdate, '%Y-%m-%d %H:%M:%S')
      WHEN event_id % 3 = 1 THEN (2024010100 + user_id)::VARCHAR
      WHEN event_id % 7 <> 0 THEN strftime(settlementdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END AS vintage
    FROM a_price""")
def _(spark, sf):
    e = F.col("event_id")
    rows = base.a_price(spark, sf).select(
        "event_id",
        F.when(e % 3 == 0, F.col("settlementdate")).alias("run_datetime"),
        F.when(e % 3 == 1, (F.lit(2024010100) + F.col("user_id")).cast("double")).alias("predispatchseqno"),
        F.when(e % 7 == 0, "NaT").otherwise(F.date_format(F.col("settlementdate") - timeaxis.minutes(60),
                                                          "yyyy-MM-dd HH:mm:ss")).alias("lastchanged"))
    return provenance.vintage(rows).select("event_id", "vintage")


@query("dedup_key", """
    SELECT event_id, regionid, settlementdate, intervention, source
    FROM (SELECT *, row_number() OVER (PARTITION BY regionid, settlementdate, intervention, source ORDER BY event_id)
            AS r FROM a_price) WHERE r = 1""")
def _(spark, sf):
    rows = base.a_price(spark, sf).select("event_id", "regionid", "settlementdate", "intervention", "source")
    return merge.dedup_first(rows, merge.dedup_key(rows.columns), [F.col("event_id")])


@query("dedup_first", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity,
            l_extendedprice) AS r FROM lineitem) WHERE r = 1""")
def _(spark, sf):
    rows = base.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                    "l_extendedprice")
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]
    return merge.dedup_first(rows, ["l_orderkey"], order).drop("l_extendedprice")


# ------------------------------------------------------------------ scans

@query("scan_union_by_name", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
      CASE WHEN event_type = 'view' THEN user_id END AS user_id FROM events""")
def _(spark, sf):
    """Two folders written with different columns, one that does not exist."""
    root = shared_folder(spark, "union")
    e = base.events(spark, sf)
    view = F.col("event_type") == "view"
    e.where(view).select("event_id", "user_id").write.parquet(f"{root}/a")
    e.where(~view).select("event_id", "value").write.parquet(f"{root}/b")
    schema = T.StructType.fromDDL("event_id bigint, value double, user_id bigint")
    return tables.union_all([tables.scan_or_empty(spark, f"{root}/{part}", schema) for part in ("a", "b", "c")])


@query("concat_months", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) IN (1996, 1997)""")
def _(spark, sf):
    root = shared_folder(spark, "months")
    o = base.table(spark, sf, "orders").withColumn("yyyymm", F.date_format("o_orderdate", "yyyyMM"))
    o.hint("rebalance", "yyyymm").write.partitionBy("yyyymm").parquet(root)
    months = [f"{root}/yyyymm={y}{m:02d}" for y in (1996, 1997) for m in range(1, 13)]
    return tables.scan(spark, months, T.StructType.fromDDL("o_orderkey bigint, o_totalprice double"))


@query("json_rows_in", """
    SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS ts, value, user_id FROM events""")
def _(spark, sf):
    when = (F.when(F.col("event_id") % 5 == 0, "soon")
            .when(F.col("event_id") % 5 == 1, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")))
    lines = base.events(spark, sf).select(F.to_json(F.struct(
        "event_id", when.alias("ts"), "value", "user_id", F.col("props").alias("unknown"))).alias("value"))
    return tables.json_rows(lines, T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, value double, user_id bigint"))


@query("json_props", "SELECT (props->>'k')::BIGINT AS k, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    rows = tables.json_rows(base.events(spark, sf).select("props"), T.StructType.fromDDL("k bigint"), "props")
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("value_counts_by_file", """
    SELECT source_file AS file_name, intervention, count(*) AS n FROM a_price GROUP BY ALL""")
def _(spark, sf):
    return tables.value_counts_by_file(base.a_price(spark, sf), "intervention", "source_file")


def landed_archives(spark, sf, root):
    """All archives stamped a minute apart, as a listing and a reader of chosen paths."""
    number = F.regexp_extract("path", r"_(\d+)\.zip$", 1).cast("int")
    stamp = F.date_format(F.lit("2024-02-01").cast("timestamp_ntz") + F.make_dt_interval(mins=number), "yyyyMMddHHmm")
    path = F.concat(F.lit("landing/Reports/Current/PUBLIC_DISPATCHIS_"), stamp, F.lit("_1.zip"))
    archives(spark, sf).select(path.alias("path"), "content").write.parquet(f"{root}/landed")
    landed = spark.read.parquet(f"{root}/landed")
    listing = landed.select("path", files.file_name(F.col("path")).alias("name"))
    return listing, lambda paths: landed.where(F.col("path").isin(paths))


@query("daily_ingest", """
    WITH told AS (SELECT count(DISTINCT event_id // 200) AS opened, count(*) AS pulled,
               count(DISTINCT (regionid, settlementdate, intervention)) AS appended FROM a_price),
    thin AS (SELECT count(*) AS thin FROM (SELECT unnest(generate_series(DATE '2024-01-23', DATE '2024-02-01', INTERVAL 1 DAY)) AS d)
             LEFT JOIN (SELECT settlementdate::DATE AS k, count(DISTINCT (regionid, settlementdate, intervention)) AS n FROM a_price GROUP BY 1)
               ON k = d::DATE WHERE coalesce(n, 0) < 120 * 0.8)
    SELECT table_name, 3::BIGINT AS windows, opened, pulled, appended, 0::BIGINT AS opened_again, 0::BIGINT AS failed, thin
    FROM told, thin, (SELECT unnest(['dispatchprice', 'dispatchregionsum']) AS table_name)""")
def _(spark, sf):
    """All archives in three consecutive windows into two tables; a second run opens none; then the thin days of the result."""
    root = shared_folder(spark, "daily-ingest")
    listing, read = landed_archives(spark, sf, root)
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-02-01 00:00:00", "2054-02-01 00:00:00"))
    stores = {n: f"{root}/{n}" for n in ("dispatchprice", "dispatchregionsum")}
    most = -(-listing.count() // 3)
    runs = [ingest.ingest_range(spark, listing, read, stores, start, end, f"{root}/log", job, root, most) for job in ("first", "second")]
    thin = ingest.thin_days(spark, stores, {n: 120 for n in stores}, "2024-02-02", 10).groupBy("table_name").agg(F.count("*").alias("thin"))
    opened, failed = batchlog.file_trail(spark, f"{root}/log").agg(F.sum("opened"), F.sum("failed")).first()
    told = batchlog.trail(spark, f"{root}/log").where("status = 'success'").groupBy("table_name").agg(
        F.count("*").alias("windows"), F.sum("pulled").alias("pulled"), F.sum("appended").alias("appended"))
    say = lambda v, name: F.lit(v).cast("bigint").alias(name)
    return (told.join(thin, "table_name", "left")
            .select("table_name", "windows", say(opened, "opened"), "pulled", "appended", say(runs[1].opened, "opened_again"),
                    say(failed, "failed"), F.coalesce("thin", F.lit(0).cast("bigint")).alias("thin")))


@query("backfill_layers", """
    WITH shifted AS (SELECT event_id, regionid, settlementdate - to_months((event_id % 3)::INT) AS settlementdate, intervention, rrp FROM a_price),
    finals AS (SELECT regionid, settlementdate, intervention, 'mmsdm' AS source, min(rrp) AS rrp FROM shifted
               WHERE settlementdate >= TIMESTAMP '2023-11-10' AND settlementdate < TIMESTAMP '2024-01-20' GROUP BY ALL),
    reports AS (SELECT regionid, settlementdate, intervention, 'report_current' AS source, arg_min(rrp, (event_id // 200, rrp)) AS rrp
                FROM a_price GROUP BY ALL)
    SELECT * FROM finals UNION ALL SELECT * FROM reports WHERE settlementdate >= TIMESTAMP '2024-01-20'""")
def _(spark, sf):
    """Months of finals from a start date, then reports; killed in the middle, run again, and once more for nothing."""
    root = shared_folder(spark, "backfill")
    t = F.col("settlementdate") - F.make_ym_interval(F.lit(0), (F.col("event_id") % 3).cast("int"))
    raw = base.a_price(spark, sf).select(t.alias("SETTLEMENTDATE"), F.col("regionid").alias("REGIONID"), F.col("intervention").alias("INTERVENTION"),
                                         F.col("rrp").alias("RRP"))
    raw = raw.withColumn("yyyymm", F.date_format("SETTLEMENTDATE", "yyyyMM"))
    raw.hint("rebalance", "yyyymm").write.partitionBy("yyyymm").parquet(f"{root}/extracts")

    def extract(table, year, month):
        path = f"{root}/extracts/yyyymm={year}{month:02d}"
        return spark.read.parquet(path) if tables.exists(spark, path) else None

    listing, read = landed_archives(spark, sf, root)
    most, calls = -(-listing.count() // 2), []

    def dies(paths):
        calls.append(len(paths))
        if len(calls) > 1:
            raise RuntimeError("killed")
        return read(paths)

    stores = {"dispatchprice": f"{root}/dispatchprice"}
    start, cutoff, end = (dt.datetime.fromisoformat(d) for d in ("2023-11-10", "2024-01-20", "2054-01-01"))
    for reader in (dies, read, read):
        try:
            backfill.backfill(spark, extract, listing, reader, stores, start, cutoff, end, f"{root}/log", "back", root, ("known_at", "rrp"), most)
        except RuntimeError as e:
            if str(e) != "killed":
                raise
    table = spark.read.schema(PRICE.schema).parquet(stores["dispatchprice"])
    final = table.where("source = 'mmsdm'")
    return merge.layered(final, table.where("source <> 'mmsdm'"), "settlementdate", timeaxis.literal(cutoff)).select(
        "regionid", "settlementdate", "intervention", "source", "rrp")
