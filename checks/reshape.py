"""Nested region documents, built from regions, nations, customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import base
from checks.base import VIEWS, query, rnd
from tidemark.operators import explore, reshape
from tidemark.session import shared_folder
from tidemark.sources import tables

DOCUMENT = """
    id string, demand bigint, mix map<string,double>, use map<string,double>,
    cities array<struct<name:string,population:bigint>>,
    links array<struct<name:string,origin:string,target:string,kind:string>>"""

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

VIEWS["placed"] = """
    SELECT r_name AS id, n_name, n_nationkey, c_custkey, c_mktsegment FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VIEWS["placed_orders"] = "SELECT id, o_orderpriority FROM orders JOIN placed ON o_custkey = c_custkey"
VIEWS["mix"] = """
    SELECT id, c_mktsegment AS key, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY id), 9) AS pct
    FROM placed GROUP BY id, c_mktsegment"""
VIEWS["uses"] = """
    SELECT id, o_orderpriority AS key, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY id), 9) AS pct
    FROM placed_orders GROUP BY id, o_orderpriority"""
VIEWS["demands"] = "SELECT id, count(*) AS demand FROM placed_orders GROUP BY id"
VIEWS["towns"] = "SELECT id, n_name AS name, count(*) AS population FROM placed GROUP BY id, n_name"


def placed(spark, sf) -> DataFrame:
    n, r = base.table(spark, sf, "nation"), base.table(spark, sf, "region")
    where = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("id"), "n_name", "n_nationkey")
    return base.table(spark, sf, "customer").join(where, F.col("c_nationkey") == F.col("n_nationkey"))


def _shares(counts: DataFrame, key: str) -> DataFrame:
    """Counts per region and key to one map of shares per region (a handful of keys each)."""
    total = counts.groupBy("id").agg(F.sum("n").alias("t"))
    pct = F.round(100 * F.col("n") / F.col("t"), 9)
    return counts.join(total, "id").groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct(key, pct))).alias("m"))


def documents(spark, sf) -> DataFrame:
    """One nested document per region; every list in it has one entry per nation or class."""
    people = placed(spark, sf)
    bought = base.table(spark, sf, "orders").join(people.select("id", "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    uses = bought.groupBy("id", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    mixes = people.groupBy("id", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    towns = people.groupBy("id", "n_name", "n_nationkey").agg(F.count(F.lit(1)).alias("n"))
    by_size = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("size"), F.col("n_name").alias("name"))))
    cities = F.transform(by_size, lambda c: F.struct(c["name"].alias("name"), (-c["size"]).alias("population")))
    link = F.struct(F.concat("id", F.lit("-"), "n_name").alias("name"), F.col("id").alias("origin"),
                    F.col("n_name").alias("target"), F.when(F.col("n_nationkey") % 2 == 0, "AC").otherwise("DC").alias("kind"))
    places = towns.groupBy("id").agg(cities.alias("cities"), F.array_sort(F.collect_list(link)).alias("links"))
    return (uses.groupBy("id").agg(F.sum("n").alias("demand"))
            .join(_shares(mixes, "c_mktsegment").withColumnRenamed("m", "mix"), "id")
            .join(_shares(uses, "o_orderpriority").withColumnRenamed("m", "use"), "id")
            .join(places, "id"))


def segment_labels(spark, sf) -> DataFrame:
    seg = F.col("key")
    return base.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("key")).distinct().select(
        "key", F.concat(seg.substr(1, 1), F.lower(seg.substr(2, 100))).alias("label"),
        F.concat(F.lit("#"), F.substring(F.md5(seg), 1, 6)).alias("colour"))


@query("reference_scan", """
    SELECT d.id, d.demand, (SELECT count(*) FROM towns t WHERE t.id = d.id) AS n_cities,
      (SELECT pct FROM mix m WHERE m.id = d.id AND m.key = 'BUILDING') AS building FROM demands d""")
def _(spark, sf):
    path = shared_folder(spark, "documents")
    documents(spark, sf).write.json(path)
    docs = tables.reference_documents(spark, path, DOCUMENT, multiline=False)
    return docs.select("id", "demand", F.size("cities").cast("bigint").alias("n_cities"),
                       F.col("mix")["BUILDING"].alias("building"))


@query("melt_mix", """
    SELECT id, key, pct, key[1] || lower(key[2:]) AS label, '#' || md5(key)[1:6] AS colour FROM mix""")
def _(spark, sf):
    return reshape.label(reshape.melt_map(documents(spark, sf), ["id"], "mix"), segment_labels(spark, sf))


@query("melt_sectors", """
    SELECT id, key, pct, CASE WHEN key[1] IN ('1', '2') THEN 'pressing' ELSE 'later' END AS label FROM uses""")
def _(spark, sf):
    long = reshape.melt_map(documents(spark, sf), ["id"], "use")
    return reshape.label_map(long, {"1-URGENT": "pressing", "2-HIGH": "pressing", "3-MEDIUM": "later",
                                    "4-NOT SPECIFIED": "later", "5-LOW": "later"})


@query("pivot_mix", "SELECT id, " + ", ".join(
    f"max(pct) FILTER (WHERE key = '{s}') AS {s}" for s in SEGMENTS) + " FROM mix GROUP BY id")
def _(spark, sf):
    return reshape.pivot_wide(reshape.melt_map(documents(spark, sf), ["id"], "mix"), "id", SEGMENTS)


@query("cities", """
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY population DESC, name)::INT AS rank, name, population
    FROM towns""")
def _(spark, sf):
    return reshape.explode_ranked(documents(spark, sf), ["id"], "cities")


@query("interconnectors", """
    SELECT DISTINCT id || '-' || n_name AS name, id AS origin, n_name AS target,
      CASE WHEN n_nationkey % 2 = 0 THEN 'AC' ELSE 'DC' END AS kind FROM placed""")
def _(spark, sf):
    return reshape.edges(documents(spark, sf), "links")


@query("regions_with_total", """
    SELECT id, demand FROM demands UNION ALL SELECT 'ALL', sum(demand)::BIGINT FROM demands""")
def _(spark, sf):
    docs = documents(spark, sf).select("id", "demand")
    total = docs.agg(F.sum("demand").alias("demand")).select(F.lit("ALL").alias("id"), "demand")
    return reshape.with_total(docs, total)


@query("weighted_mix", """
    SELECT key, round(sum(pct * demand) / (SELECT sum(demand) FROM demands), 9) AS pct
    FROM mix JOIN demands USING (id) GROUP BY key""")
def _(spark, sf):
    docs = documents(spark, sf)
    return rnd(reshape.weighted_average(reshape.melt_map(docs, ["id"], "mix"), docs, "id", "demand"))


@query("share_table", "SELECT id, key AS \"Fuel\", pct AS share FROM mix WHERE pct > 0")
def _(spark, sf):
    return reshape.share_table(reshape.melt_map(documents(spark, sf), ["id"], "mix"), "key", "Fuel", by=["id"])


@query("pivot_events", "SELECT regionid, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in ("view", "signup", "purchase", "error", "click"))
       + " FROM a_price GROUP BY regionid")
def _(spark, sf):
    kinds = ["view", "signup", "purchase", "error", "click"]
    counts = base.a_price(spark, sf).groupBy("regionid", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return reshape.pivot_wide(counts, "regionid", kinds, "event_type", "n")


@query("melt_day_stats", " UNION ALL ".join(
    f"SELECT regionid, '{m}' AS measure, round({e}, 9) AS value FROM price_final"
    " WHERE trading_day = DATE '2024-01-15' GROUP BY regionid"
    for m, e in (("min", "min(rrp)"), ("mean", "avg(rrp)"), ("median", "median(rrp)"), ("max", "max(rrp)"))))
def _(spark, sf):
    stats = explore.price_day_stats(base.price_final(spark, sf), "2024-01-15")
    names = ["min", "mean", "median", "max"]
    return rnd(stats.unpivot(["regionid"], names, "measure", "value"))
