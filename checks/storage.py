"""Merges, partitioned writes, exports, range reads and the dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import base
from checks.base import PARAMS, query, rnd, rounded
from checks.points import FEATURE_DOUBLES, FEATURE_INTS, FEATURES_SQL, features
from tidemark.dictionary import ROWS
from tidemark.functions import timeaxis
from tidemark.operators import asof, batchlog, catalog, clean, layout, merge, quality, serving
from tidemark.plans import features as plan
from tidemark.plans import backfill, warehouse
from tidemark.session import shared_folder
from tidemark.sources import tables
from tidemark.specs import SPECS, TableSpec

PRICE = SPECS["dispatchprice"]
KEY = list(PRICE.key)
ORDERS = TableSpec("orders", "o_orderdate", ("o_orderkey",), (
    ("o_orderkey", "bigint"), ("o_orderdate", "timestamp_ntz"), ("o_totalprice", "double")))


def sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming rows: two thirds of the events each, one third in both."""
    p = base.a_price(spark, sf).select("event_id", "regionid", "settlementdate", "intervention", "source", "rrp",
                                       "known_at", "source_file")
    return p.where(F.col("event_id") % 3 != 2), p.where(F.col("event_id") % 3 != 0)


FIRST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regionid, settlementdate, intervention, source
             ORDER BY side, event_id) AS r
           FROM (SELECT *, 1 AS side FROM a_price WHERE event_id % 3 <> 2
                 UNION ALL SELECT *, 2 FROM a_price WHERE event_id % 3 <> 0)) WHERE r = 1"""
HELD = """EXISTS (SELECT 1 FROM a_price s WHERE s.event_id % 3 <> 2 AND s.regionid = i.regionid
           AND s.settlementdate = i.settlementdate AND s.intervention = i.intervention AND s.source = i.source
           AND s.settlementdate >= TIMESTAMP '2024-01-05' AND s.settlementdate < TIMESTAMP '2024-01-25')"""
WINDOW = ("2024-01-05", "2024-01-25")


def bounds():
    return tuple(F.lit(d).cast("timestamp_ntz") for d in WINDOW)


@query("merge_partition", f"""
    SELECT regionid, settlementdate, intervention, source, rrp, source_file FROM ({FIRST})""")
def _(spark, sf):
    """Two merges into an empty table; the stored row wins and the first incoming one otherwise."""
    path = shared_folder(spark, "merge")
    for side in sides(spark, sf):
        merge.merge_into(spark, path, side, PRICE, [F.col("event_id")])
    return spark.read.schema(PRICE.schema).parquet(path).select(*KEY, "rrp", "source_file")


@query("merge_new_rows", f"""
    SELECT regionid, settlementdate, intervention, source, event_id FROM ({FIRST}) WHERE side = 2""")
def _(spark, sf):
    stored, incoming = sides(spark, sf)
    return merge.merge_new(stored, incoming, KEY, [F.col("event_id")]).select(*KEY, "event_id")


@query("merge_dry_run", f"SELECT 'dispatchprice' AS table_name, count(*) AS would_append FROM ({FIRST}) WHERE side = 2")
def _(spark, sf):
    path = shared_folder(spark, "dry")
    stored, incoming = sides(spark, sf)
    merge.merge_into(spark, path, stored, PRICE, [F.col("event_id")])
    told = merge.merge_into(spark, path, incoming, PRICE, [F.col("event_id")], dry_run=True)
    new, _ = merge.plan_merge(spark, path, incoming, PRICE, [F.col("event_id")])
    same = new.agg(F.count(F.lit(1)).alias("would_append")).where(F.col("would_append") == told.appended)
    return same.select(F.lit(PRICE.name).alias("table_name"), "would_append")


@query("merge_held", f"SELECT i.event_id FROM a_price i WHERE i.event_id % 3 <> 0 AND {HELD}")
def _(spark, sf):
    stored, incoming = sides(spark, sf)
    return merge.held(stored, incoming, KEY, "settlementdate", bounds()).select("event_id")


NULLED = "(SELECT * REPLACE (CASE WHEN event_id % 31 = 0 THEN NULL ELSE regionid END AS regionid) FROM a_price)"


@query("merge_insert", f"SELECT i.event_id FROM {NULLED} i WHERE i.event_id % 3 <> 0 AND NOT {HELD}")
def _(spark, sf):
    """Rows with a null key never match a stored row and are inserted."""
    stored, incoming = sides(spark, sf)
    incoming = incoming.withColumn("regionid", F.when(F.col("event_id") % 31 != 0, F.col("regionid")))
    return merge.missing(stored, incoming, KEY, "settlementdate", bounds()).select("event_id")


@query("merge_stats", """
    SELECT sum(n)::BIGINT AS pulled, sum(CASE WHEN held THEN n ELSE 0 END)::BIGINT AS already_held,
      sum(CASE WHEN held THEN 0 ELSE n END)::BIGINT AS inserted, count(*) FILTER (WHERE NOT held) AS keys_added,
      (sum(n) - count(*) FILTER (WHERE NOT held))::BIGINT AS duplicates
    FROM (SELECT count(*) FILTER (WHERE event_id % 3 <> 0) AS n, count(*) FILTER (WHERE event_id % 3 <> 2) > 0 AS held
          FROM a_price GROUP BY regionid, settlementdate, intervention, source) WHERE n > 0""")
def _(spark, sf):
    return merge.merge_counts(*sides(spark, sf), KEY)


LOGGED = ["job", "batch", "table_name", "window_start", "window_end", "pulled", "appended", "duplicates", "already_held",
          "status", "message"]


@query("batch_log", f"""
    WITH i AS (SELECT *, {HELD} AS h FROM a_price i WHERE i.event_id % 3 <> 0)
    SELECT 'dispatchprice' AS job, 'b1' AS batch, 'dispatchprice' AS table_name, '2024-01-05' AS window_start,
      '2024-01-25' AS window_end, count(*) AS pulled,
      count(DISTINCT (regionid, settlementdate, intervention, source)) FILTER (WHERE NOT h) AS appended,
      count(*) FILTER (WHERE NOT h) - count(DISTINCT (regionid, settlementdate, intervention, source)) FILTER (WHERE NOT h)
        AS duplicates,
      count(*) FILTER (WHERE h) AS already_held, 'success' AS status, NULL::VARCHAR AS message FROM i""")
def _(spark, sf):
    """A logged merge into a stored table, read back from its log."""
    root = shared_folder(spark, "log")
    stored, incoming = sides(spark, sf)
    merge.merge_into(spark, f"{root}/t", stored, PRICE, [F.col("event_id")])
    batchlog.merge_all(spark, f"{root}/log", "b1", [(PRICE, f"{root}/t", lambda: incoming, [F.col("event_id")])], WINDOW)
    return batchlog.trail(spark, f"{root}/log").select(*LOGGED)


@query("batch_log_runs", """
    WITH k AS (SELECT regionid, settlementdate, intervention, source, count(*) FILTER (WHERE event_id % 3 <> 2) AS a,
                 count(*) FILTER (WHERE event_id % 3 <> 0) AS b FROM a_price GROUP BY ALL)
    SELECT 'first' AS batch, sum(a)::BIGINT AS pulled, count(*) FILTER (WHERE a > 0) AS appended,
      (sum(a) - count(*) FILTER (WHERE a > 0))::BIGINT AS duplicates, 0::BIGINT AS already_held, 'success' AS status FROM k
    UNION ALL SELECT 'second', sum(b)::BIGINT, count(*) FILTER (WHERE a = 0),
      (sum(CASE WHEN a = 0 THEN b - 1 ELSE 0 END))::BIGINT, coalesce(sum(CASE WHEN a > 0 THEN b END), 0)::BIGINT, 'success' FROM k
    UNION ALL SELECT 'third', 0, 0, 0, 0, 'failed'""")
def _(spark, sf):
    """Two batches, both tried again, and one whose source fails: what the log says of each."""
    root = shared_folder(spark, "runs")
    stored, incoming = sides(spark, sf)

    def broken():
        raise RuntimeError("feed is down")

    for batch, load in [("first", lambda: stored), ("second", lambda: incoming), ("first", lambda: stored),
                        ("third", broken), ("second", lambda: incoming)]:
        batchlog.merge_once(spark, f"{root}/log", "prices", batch, f"{root}/t", PRICE, load, [F.col("event_id")])
    return batchlog.trail(spark, f"{root}/log").select("batch", "pulled", "appended", "duplicates", "already_held", "status")


def dated_orders(spark, sf) -> DataFrame:
    return base.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 29 != 0, F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice")


@query("write_by_year", """
    SELECT year(o_orderdate)::INT AS year, count(*) AS n, min(o_orderkey) AS first_key FROM orders
    WHERE o_orderkey % 29 <> 0 GROUP BY 1""")
def _(spark, sf):
    path = shared_folder(spark, "years")
    merge.write_partitioned(dated_orders(spark, sf), ORDERS, path)
    return spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


@query("rebuild_years", """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 29 <> 0""")
def _(spark, sf):
    """Only the chosen year is replaced."""
    path = shared_folder(spark, "rebuild")
    rows = dated_orders(spark, sf)
    merge.write_partitioned(rows, ORDERS, path)
    merge.write_partitioned(rows.withColumn("o_totalprice", 2 * F.col("o_totalprice")), ORDERS, path, "overwrite", [1996])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query("rebuild_from", """
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '1996-07-10' THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 29 <> 0 AND o_orderdate < DATE '1998-01-01'""")
def _(spark, sf):
    """Everything from a date on is replaced, within its year and after it; years the new rows do not reach go."""
    path = shared_folder(spark, "rebuild-from")
    rows = dated_orders(spark, sf)
    merge.write_partitioned(rows, ORDERS, path)
    fresh = rows.withColumn("o_totalprice", 2 * F.col("o_totalprice")).where(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"))
    backfill.rebuild_from(spark, path, fresh, ORDERS, F.lit("1996-07-10").cast("timestamp_ntz"))
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query("load_sorted", """
    SELECT strftime(o_orderdate, '%Y%m')::INT AS yyyymm, count(*) AS n FROM orders WHERE o_orderkey % 29 <> 0 GROUP BY 1""")
def _(spark, sf):
    path = shared_folder(spark, "sorted")
    merge.write_sorted(dated_orders(spark, sf), ORDERS, path)
    return spark.read.parquet(path).groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n"))


@query("layer_union", """
    SELECT event_id, source FROM a_price WHERE (source = 'mmsdm' AND settlementdate < TIMESTAMP '2024-01-20')
      OR (source <> 'mmsdm' AND settlementdate >= TIMESTAMP '2024-01-20')""")
def _(spark, sf):
    p = base.a_price(spark, sf)
    final = F.col("source") == "mmsdm"
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    return merge.layered(p.where(final).drop("known_at"), p.where(~final), "settlementdate", cut).select("event_id", "source")


@query("materialise_features", FEATURES_SQL)
def _(spark, sf):
    path = shared_folder(spark, "features")
    warehouse.materialise(features(spark, sf), path)
    return rnd(spark.read.parquet(path).select(*plan.feature_columns()))


@query("named_views", """
    SELECT p.regionid, p.trading_day, p.spike_count_7d, o.spike FROM persistence p
    JOIN daily_outcome o ON o.regionid = p.regionid AND o.trading_day = p.trading_day""")
def _(spark, sf):
    warehouse.register({"dispatchprice": base.a_price(spark, sf), "dispatchregionsum": base.a_state(spark, sf),
                        "predispatchprice": base.a_fc_price(spark, sf),
                        "predispatchregionsum": base.a_fc_state(spark, sf)}, PARAMS, ["event_id"])
    return spark.sql("""SELECT p.regionid, p.trading_day, p.spike_count_7d, o.spike FROM v_persistence p
                        JOIN v_daily_outcome o ON o.regionid = p.regionid AND o.trading_day = p.trading_day""")


@query("export_training_csv", rounded(
    "features", [c for c in FEATURE_DOUBLES if not c.startswith("actual_")],
    [c for c in FEATURE_INTS if not c.startswith("actual_")]))
def _(spark, sf):
    path = shared_folder(spark, "csv")
    rows = rnd(features(spark, sf))
    serving.export_csv(rows, path, plan.OUTCOME_COLUMNS)
    kept = T.StructType([f for f in rows.schema if f.name not in plan.OUTCOME_COLUMNS])
    return spark.read.schema(kept).option("header", True).csv(path)


@query("serialise_rows", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CASE WHEN event_id % 10 <> 0 THEN rrp END AS rrp, regionid
    FROM a_price""")
def _(spark, sf):
    rows = base.a_price(spark, sf).select(
        "event_id", "ts", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("rrp")).alias("rrp"),
        "regionid")
    return serving.plain(rows)


@query("json_rows_out", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, regionid, rrp FROM a_price")
def _(spark, sf):
    """Rows to JSON text and back."""
    text = serving.to_json_rows(base.a_price(spark, sf).select("event_id", "ts", "regionid", "rrp"))
    return tables.json_rows(text, T.StructType.fromDDL("event_id bigint, ts string, regionid string, rrp double"))


# ------------------------------------------------------------------ range reads

PAGE_ORDER = ["settlementdate", "regionid", "intervention", "source", "event_id"]
IN_RANGE = "settlementdate >= TIMESTAMP '2024-01-08' AND settlementdate < TIMESTAMP '2024-01-22'"


def in_range(spark, sf, region=None) -> DataFrame:
    rows = base.a_price(spark, sf).select("event_id", "settlementdate", "regionid", "intervention", "source", "rrp")
    return serving.range_read(rows, PRICE, "2024-01-08", "2024-01-22", region)


@query("range_page", f"""
    SELECT event_id, settlementdate, regionid, intervention, source, rrp FROM a_price WHERE {IN_RANGE}
    ORDER BY settlementdate, regionid, intervention, source, event_id LIMIT 500 OFFSET 1000""")
def _(spark, sf):
    return serving.page(in_range(spark, sf), PAGE_ORDER, 500, 1000)


@query("range_page_region", f"""
    SELECT event_id, settlementdate, regionid, intervention, source, rrp FROM a_price
    WHERE {IN_RANGE} AND regionid = 'SA1'
    ORDER BY settlementdate, regionid, intervention, source, event_id LIMIT 200""")
def _(spark, sf):
    return serving.page(in_range(spark, sf, "sa1"), PAGE_ORDER, 200)


@query("range_page_after", f"""
    SELECT event_id, settlementdate, regionid, intervention, source, rrp FROM a_price
    WHERE {IN_RANGE} AND (settlementdate, regionid, intervention, source, event_id)
      > (TIMESTAMP '2024-01-10 05:00:00', 'QLD1', 0, 'mmsdm', 0)
    ORDER BY settlementdate, regionid, intervention, source, event_id LIMIT 500""")
def _(spark, sf):
    import datetime as dt
    after = {"settlementdate": dt.datetime(2024, 1, 10, 5), "regionid": "QLD1", "intervention": 0, "source": "mmsdm",
             "event_id": 0}
    return serving.page_after(in_range(spark, sf), PAGE_ORDER, after, 500)


@query("range_last_days", """
    SELECT event_id, settlementdate, regionid FROM a_price
    WHERE settlementdate >= TIMESTAMP '2024-01-18' AND settlementdate < TIMESTAMP '2024-01-23'""")
def _(spark, sf):
    return serving.range_last_days(base.a_price(spark, sf), PRICE, "2024-01-20", 2).select(
        "event_id", "settlementdate", "regionid")


# ------------------------------------------------------------------ dictionary beside measured columns

PRICED = ["event_id", "regionid", "settlementdate", "intervention", "rrp", "price_status", "apcflag", "source",
          "known_at", "user_id"]
MEASURED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct FROM a_price"
    for c in PRICED)
WORDS = {(t, c): (timing, unit) for t, c, timing, unit, _ in ROWS}


def measured(spark, sf) -> DataFrame:
    return quality.profile_columns(base.a_price(spark, sf).select(*PRICED)).select(
        F.lit("dispatchprice").alias("table_name"), "column_name", "n_null", "n_distinct")


def word_case(field: int, table: str, columns: list[str]) -> str:
    """CASE over column names giving a dictionary field."""
    hits = [(c, WORDS.get((table, c)) or WORDS.get(("*", c))) for c in columns]
    return "CASE column_name " + " ".join(f"WHEN '{c}' THEN '{w[field]}'" for c, w in hits if w) + " END"


@query("describe_columns", f"""
    SELECT 'dispatchprice' AS table_name, column_name, n_null, n_distinct,
      {word_case(0, 'dispatchprice', PRICED)} AS timing, {word_case(1, 'dispatchprice', PRICED)} AS unit
    FROM ({MEASURED})""")
def _(spark, sf):
    return catalog.describe_columns(measured(spark, sf), catalog.dictionary(spark)).drop("description")


@query("undocumented_columns", f"""
    SELECT 'dispatchprice' AS table_name, column_name, n_null, n_distinct FROM ({MEASURED})
    WHERE column_name IN ('event_id', 'user_id')""")
def _(spark, sf):
    return catalog.undocumented(measured(spark, sf), catalog.dictionary(spark))


FEATURE_NAMES = plan.feature_columns()


@query("dictionary_sorted", f"""
    SELECT 'features' AS table_name, column_name, n_null, timing, row_number() OVER (ORDER BY CASE timing
      WHEN 'key' THEN 1 WHEN 'target' THEN 2 WHEN 'outcome' THEN 3 ELSE 4 END, column_name)::INT AS place
    FROM (SELECT column_name, n_null, {word_case(0, 'features', FEATURE_NAMES)} AS timing FROM (
      {" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM features"
                          for c in FEATURE_NAMES)}))""")
def _(spark, sf):
    columns = quality.profile_columns(features(spark, sf)).select(
        F.lit("features").alias("table_name"), "column_name", "n_null")
    described = catalog.describe_columns(columns, catalog.dictionary(spark))
    return catalog.numbered_entries(described).select("table_name", "column_name", "n_null", "timing", "place")


@query("dictionary_refresh", """
    SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN value + 1 ELSE value END AS value FROM events""")
def _(spark, sf):
    """One slice of a table deleted and inserted again, twice."""
    rows = base.events(spark, sf).select("event_id", "event_type", "value")
    fresh = rows.withColumn("value", F.col("value") + 1)
    once = merge.replace_slice(rows, "event_type", "view", fresh)
    return merge.replace_slice(once, "event_type", "view", fresh)


# ------------------------------------------------------------------ layout for joins

BUCKETS = 16
#: Forecasts that a bucket is laid out for.
PER_BUCKET = 250_000


def stored_in_buckets(spark, sf) -> dict[str, DataFrame]:
    """Forecast prices, forecast states and actual prices in like buckets, opened again by folder and layout."""
    root = shared_folder(spark, "buckets")
    run = root.rsplit("-", 1)[1]
    actual = base.price_final(spark, sf).select("regionid", F.col("settlementdate").alias("datetime"), F.col("rrp").alias("actual_rrp"))
    # The layout is chosen at the load, from what is loaded: a bucket is one task of every later join.
    buckets = layout.buckets_for(base.VINTAGES * base.events(spark, sf).count(), PER_BUCKET, BUCKETS)
    frames = {"fc_price": base.a_fc_price(spark, sf), "fc_state": base.a_fc_state(spark, sf), "actual": actual}
    out = {}
    for name, df in frames.items():
        layout.write_bucketed(df, f"{name}_{run}", f"{root}/{name}", buckets)
        out[name] = layout.open_bucketed(spark, f"{name}_again_{run}", f"{root}/{name}", df.schema, buckets)
    return out


@query("stored_forecast_join", """
    SELECT f.regionid, f.datetime, f.vintage, f.source, f.rrp, f.totaldemand, f.margin, p.rrp AS actual_rrp
    FROM forecast f JOIN price_final p ON f.regionid = p.regionid AND f.datetime = p.settlementdate""")
def _(spark, sf):
    """Three stored tables joined bucket by bucket."""
    t = stored_in_buckets(layout.allow_partial_keys(spark), sf)
    joined = clean.forecast(t["fc_price"], t["fc_state"]).join(t["actual"], list(layout.INTERVAL))
    return joined.select("regionid", "datetime", "vintage", "source", "rrp", "totaldemand", "margin", "actual_rrp")


@query("stored_asof", """
    SELECT 'ev' AS cutoff, regionid, datetime, vintage, rrp FROM asof_2000
    UNION ALL SELECT 'fc', regionid, datetime, vintage, rrp FROM asof_1300""")
def _(spark, sf):
    """The as-of selection over stored forecasts: scan, join and aggregate without an exchange."""
    t = stored_in_buckets(layout.allow_partial_keys(spark), sf)
    picked = asof.forecast_asof(clean.forecast(t["fc_price"], t["fc_state"]), {"ev": 20, "fc": 13}, ["vintage", "rrp"])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("cutoff"), F.col(n).alias("row")) for n in ("ev", "fc")]))
    return (picked.select("regionid", "datetime", pairs.alias("p")).where(F.col("p.row").isNotNull())
            .select("p.cutoff", "regionid", "datetime", "p.row.vintage", "p.row.rrp"))
