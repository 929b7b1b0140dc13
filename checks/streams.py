"""Streaming jobs run over landed events until nothing is left, then read back."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import base
from checks.base import query, rnd, rounded
from checks.ingest import archives
from checks.points import OUTCOME
from checks.storage import FIRST, KEY, PRICE
from tidemark.functions import timeaxis
from tidemark.operators import asof, batchlog, clean, daily
from tidemark.session import shared_folder
from tidemark.specs import SPECS
from tidemark.streaming import corrections, jobs


def once(df: DataFrame, folder: str) -> DataFrame:
    """``df`` worked out once and stored, for what reads it several times."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def landings(df: DataFrame, folder: str, time_col: str) -> Iterator[None]:
    """Three landings, oldest rows first, one at every step; the rows are worked out once."""
    rows = once(df, f"{folder}-made")
    t = F.col(time_col)
    a, b = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-21"))
    for part in (t < a, (t >= a) & (t < b), t >= b):
        rows.where(part).write.mode("append").parquet(folder)
        yield


def land(df: DataFrame, folder: str, time_col: str) -> None:
    """All three landings."""
    for _ in landings(df, folder, time_col):
        pass


def landed(spark: SparkSession, df: DataFrame, root: str, time_col: str, files_per_batch: int | None = None) -> DataFrame:
    land(df, f"{root}/landing", time_col)
    return jobs.landed(spark, f"{root}/landing", df.schema, files_per_batch)


@query("stream_merge", f"SELECT regionid, settlementdate, intervention, source FROM ({FIRST})")
def _(spark, sf):
    """Overlapping landings; each key is stored once."""
    root = shared_folder(spark, "stream-merge")
    p = base.a_price(spark, sf).select("event_id", *KEY, "rrp", "known_at", "source_file")
    p.where(F.col("event_id") % 3 != 2).write.mode("append").parquet(f"{root}/landing")
    p.where(F.col("event_id") % 3 != 0).write.mode("append").parquet(f"{root}/landing")
    stream = jobs.landed(spark, f"{root}/landing", p.schema, 2)
    jobs.finish(jobs.stream_merge(stream, f"{root}/table", PRICE, f"{root}/cp", [F.col("event_id")], f"{root}/log"))
    return spark.read.schema(PRICE.schema).parquet(f"{root}/table").select(*KEY)


@query("stream_batch_log", """
    SELECT 'prices' AS job, 'dispatchprice' AS table_name, 'success' AS status, count(*) AS pulled,
      count(DISTINCT (regionid, settlementdate, intervention, source)) AS appended,
      count(*) - count(DISTINCT (regionid, settlementdate, intervention, source)) AS duplicates,
      0::BIGINT AS already_held FROM a_price""")
def _(spark, sf):
    """The logged counts of all batches, after a second run with a lost checkpoint replayed them.

    Landed in key order, so a key never spans two batches and totals do not depend on them.
    """
    root = shared_folder(spark, "stream-log")
    p = base.a_price(spark, sf).select("event_id", *KEY, "rrp", "known_at", "source_file")
    land(p, f"{root}/landing", "settlementdate")
    for checkpoint in ("cp1", "cp2"):
        stream = jobs.landed(spark, f"{root}/landing", p.schema)
        jobs.finish(jobs.stream_merge(stream, f"{root}/table", PRICE, f"{root}/{checkpoint}", [F.col("event_id")],
                                      f"{root}/log", name="prices"))
    return batchlog.trail(spark, f"{root}/log").groupBy("job", "table_name", "status").agg(
        *[F.sum(c).alias(c) for c in ("pulled", "appended", "duplicates", "already_held")])


@query("stream_ingest", """
    SELECT regionid, settlementdate, intervention, source, rrp FROM (
      SELECT *, row_number() OVER (PARTITION BY regionid, settlementdate, intervention ORDER BY event_id // 200, rrp) AS r
      FROM (SELECT * REPLACE ('report_current' AS source) FROM a_price)) WHERE r = 1""")
def _(spark, sf):
    """Archives landed as rows of bytes, parsed and merged batch by batch."""
    root = shared_folder(spark, "stream-ingest")
    archives(spark, sf).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema("path string, content binary").parquet(f"{root}/landing")
    jobs.finish(jobs.stream_ingest(stream, f"{root}/table", PRICE, f"{root}/cp", order=["known_at", "rrp"]))
    return spark.read.schema(PRICE.schema).parquet(f"{root}/table").select(*KEY, "rrp")


@query("stream_late_dedup", """
    WITH p AS (SELECT regionid, settlementdate, intervention, source,
                 bool_and(settlementdate < TIMESTAMP '2024-01-06' AND event_id % 10 = 0) AS only_late FROM a_price GROUP BY ALL)
    SELECT CASE WHEN only_late THEN 'recovered' ELSE 'kept' END AS how, * EXCLUDE (only_late) FROM p""")
def _(spark, sf):
    """What watermarked deduplication kept in time, and what a batch merge recovers of the rows that came too late."""
    root = shared_folder(spark, "stream-dedup")
    p = base.a_price(spark, sf).select("event_id", *KEY, "rrp")
    t = F.col("settlementdate")
    late = (t < F.lit("2024-01-06").cast("timestamp_ntz")) & (F.col("event_id") % 10 == 0)

    def run() -> None:
        stream = jobs.landed(spark, f"{root}/landing", p.schema)
        jobs.finish(jobs.stream_dedup(stream, KEY, "settlementdate", f"{root}/table", f"{root}/cp"))

    # A run for every landing, whose files are one batch: batches do not grow in number with the files, and the
    # files of a landing, which lie in no order of time, are not late for each other.  What lands after the last
    # of them has passed the watermark is late.
    for _ in landings(p.where(~late), f"{root}/landing", "settlementdate"):
        run()
    p.where(late).write.mode("append").parquet(f"{root}/landing")
    run()
    stored = spark.read.schema(p.schema).parquet(f"{root}/table")
    back = jobs.late_rows(p, stored, KEY, [F.col("event_id")])
    return (stored.select(F.lit("kept").alias("how"), *KEY)
            .unionByName(back.select(F.lit("recovered").alias("how"), *KEY)))


@query("stream_daily_outcome", rounded("""(
    SELECT regionid, (settlementdate - INTERVAL 245 MINUTE)::DATE AS trading_day, max(rrp) AS actual_max_rrp,
      avg(rrp) AS actual_mean_rrp, min(rrp) AS actual_min_rrp,
      count(*) FILTER (WHERE rrp > 300) AS actual_n_over_300, count(*) FILTER (WHERE rrp < 0) AS actual_n_negative,
      CAST(max(rrp) > 300 AS INT) AS spike, count(*) AS n_intervals
    FROM price_final GROUP BY ALL)""", *OUTCOME))
def _(spark, sf):
    root = shared_folder(spark, "stream-daily")
    final = base.price_final(spark, sf).select("regionid", "settlementdate", "rrp")
    stream = landed(spark, final, root, "settlementdate")
    jobs.finish(jobs.stream_daily_outcome(stream, f"{root}/out", f"{root}/cp"))
    return rnd(jobs.latest(spark.read.parquet(f"{root}/out"), ["regionid", "trading_day"]))


@query("stream_tumble_30m", """
    SELECT regionid, bucket_end, round(avg(rrp), 9) AS mean_rrp, count(*) AS n_intervals
    FROM (SELECT regionid, rrp, time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 1 MICROSECOND) + INTERVAL 30 MINUTE
            AS bucket_end FROM a_price WHERE intervention = 0) GROUP BY ALL""")
def _(spark, sf):
    root = shared_folder(spark, "stream-tumble")
    rows = clean.pricing_run(base.a_price(spark, sf)).select("regionid", "ts", "rrp")
    stream = landed(spark, rows, root, "ts")
    jobs.finish(jobs.stream_tumble(stream, "ts", ["regionid"], [
        F.avg("rrp").alias("mean_rrp"), F.count(F.lit(1)).alias("n_intervals")], f"{root}/out", f"{root}/cp"))
    return rnd(jobs.latest(spark.read.parquet(f"{root}/out"), ["regionid", "bucket_end"]))


@query("stream_asof_latest", "SELECT regionid, datetime, trading_day, vintage, rrp FROM asof_2000")
def _(spark, sf):
    root = shared_folder(spark, "stream-asof")
    rows = base.forecast(spark, sf).select("regionid", "datetime", "trading_day", "vintage", "source", "known_at",
                                           "run_datetime", "rrp")
    stream = landed(spark, rows, root, "datetime")
    jobs.finish(jobs.stream_asof_latest(stream, 20, ["vintage", "rrp"], f"{root}/out", f"{root}/cp"))
    return jobs.latest(spark.read.parquet(f"{root}/out"), ["regionid", "datetime"])


@query("stream_coverage", """
    SELECT d::DATE AS day, coalesce(n, 0) AS n_rows
    FROM (SELECT unnest(generate_series(DATE '2024-01-23', DATE '2024-02-01', INTERVAL 1 DAY)) AS d)
    LEFT JOIN (SELECT settlementdate::DATE AS k, count(*) AS n FROM a_price GROUP BY 1) ON k = d::DATE
    WHERE coalesce(n, 0) < 400 * 0.8""")
def _(spark, sf):
    root = shared_folder(spark, "stream-coverage")
    stream = landed(spark, base.a_price(spark, sf).select("settlementdate", "event_id"), root, "settlementdate")
    jobs.finish(jobs.stream_coverage(stream, "settlementdate", f"{root}/out", f"{root}/cp"))
    counts = jobs.latest(spark.read.parquet(f"{root}/out"), ["day"])
    return jobs.thin(counts, "2024-02-02", 10, 400)


@query("stream_observed", """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE rrp < 0) AS n_negative, count(*) FILTER (WHERE rrp > 300) AS n_over_300,
      max(settlementdate) AS newest, 3::BIGINT AS batches FROM a_price""")
def _(spark, sf):
    """Coverage and price counts of every micro-batch, observed on the rows a merge stores."""
    root = shared_folder(spark, "observed")
    rows = base.a_price(spark, sf).select("event_id", *KEY, "rrp", "known_at", "source_file")
    t = F.col("settlementdate")
    a, b = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-21"))
    with jobs.observing(spark) as seen:
        for part in (t < a, (t >= a) & (t < b), t >= b):
            rows.where(part).write.mode("append").parquet(f"{root}/landing")
            stream = jobs.landed(spark, f"{root}/landing", rows.schema).observe(
                "prices", F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("rrp") < 0).alias("n_negative"),
                F.count_if(F.col("rrp") > 300).alias("n_over_300"), F.max("settlementdate").alias("newest"))
            jobs.finish(jobs.stream_merge(stream, f"{root}/table", PRICE, f"{root}/cp", [F.col("event_id")]))
    told = [m for m in seen.of("prices") if m["n_rows"]]
    day = spark.createDataFrame([tuple(m[c] for c in ("n_rows", "n_negative", "n_over_300", "newest")) for m in told],
                                "n_rows bigint, n_negative bigint, n_over_300 bigint, newest timestamp_ntz")
    return day.agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_negative", "n_over_300")], F.max("newest").alias("newest"),
                   F.count("*").alias("batches"))


# ------------------------------------------------------------------ rows far behind any watermark

def corrected(spark: SparkSession, rows: DataFrame, late, root: str, keys: dict, day, result, compacted: bool = False) -> DataFrame:
    """The newest versions after the late rows landed weeks behind the newest of the others."""
    rows = once(rows, f"{root}/made")
    land(rows.where(~late), f"{root}/landing", "ts")
    for part in (None, rows.where(late)):
        if part is not None:  # one file only where files are counted into batches
            (part.coalesce(1) if compacted else part).write.mode("append").parquet(f"{root}/landing")
        stream = jobs.landed(spark, f"{root}/landing", rows.schema, 2 if compacted else None)
        jobs.finish(corrections.corrected(stream, keys, day, result, f"{root}/out", f"{root}/cp", fan_in=2 if compacted else 10))
    schema = result(rows.limit(0)).schema
    return corrections.latest(spark, f"{root}/out", schema, list(keys))


def _late(event_id="event_id", ts="ts"):
    return (F.col(event_id) % 10 == 0) & (F.col(ts) < F.lit("2024-01-06").cast("timestamp_ntz"))


PRICES = ["event_id", "ts", "regionid", "settlementdate", "intervention", "source", "rrp", "price_status", "known_at"]


@query("stream_late_outcome", rounded("""(
    SELECT regionid, trading_day, max(rrp) AS actual_max_rrp, avg(rrp) AS actual_mean_rrp, min(rrp) AS actual_min_rrp,
      count(*) FILTER (WHERE rrp > 300) AS actual_n_over_300, count(*) FILTER (WHERE rrp < 0) AS actual_n_negative,
      CAST(max(rrp) > 300 AS INT) AS spike, count(*) AS n_intervals
    FROM price_final GROUP BY ALL)""", *OUTCOME))
def _(spark, sf):
    """A late row of a trusted source replaces the price of its interval, so days are computed again from their rows."""
    def result(rows):
        final = clean.price_final(rows, ["event_id"])
        return final.groupBy("regionid", "trading_day").agg(*daily.outcome_measures())

    keys = {"regionid": F.col("regionid"), "trading_day": timeaxis.trading_day(F.col("settlementdate"))}
    rows = base.a_price(spark, sf).select(*PRICES)
    return rnd(corrected(spark, rows, _late(), shared_folder(spark, "late-outcome"), keys, keys["trading_day"], result))


@query("stream_late_tumble", """
    SELECT regionid, bucket_end, round(avg(rrp), 9) AS mean_rrp, count(*) AS n_intervals
    FROM (SELECT regionid, rrp, time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 1 MICROSECOND) + INTERVAL 30 MINUTE
            AS bucket_end FROM a_price WHERE intervention = 0) GROUP BY ALL""")
def _(spark, sf):
    end = timeaxis.interval_end_bucket(F.col("ts"), "30 minutes")

    def result(rows):
        return rows.groupBy("regionid", end.alias("bucket_end")).agg(
            F.avg("rrp").alias("mean_rrp"), F.count(F.lit(1)).alias("n_intervals"))

    rows = clean.pricing_run(base.a_price(spark, sf)).select("event_id", "ts", "regionid", "rrp")
    keys = {"regionid": F.col("regionid"), "bucket_end": end}
    return rnd(corrected(spark, rows, _late(), shared_folder(spark, "late-tumble"), keys, F.to_date("ts"), result))


@query("stream_late_asof", "SELECT regionid, datetime, trading_day, vintage, rrp FROM asof_2000")
def _(spark, sf):
    """Forecasts that arrive weeks after their interval take their place if they were knowable in time."""
    def result(rows):
        return asof.unpack(asof.forecast_asof(rows, {"ev": 20}, ["vintage", "rrp"]), "ev")

    rows = base.forecast(spark, sf).select("regionid", "datetime", "trading_day", "vintage", "source", "known_at",
                                           "run_datetime", "rrp")
    rows = rows.withColumns({"ts": F.col("datetime"), "event_id": F.substring_index("vintage", "-", -1).cast("bigint")})
    keys = {c: F.col(c) for c in asof.FORECAST_KEYS}
    return corrected(spark, rows, _late(), shared_folder(spark, "late-asof"), keys, F.col("trading_day"), result)


@query("stream_late_coverage", """
    SELECT d::DATE AS day, coalesce(n, 0) AS n_rows
    FROM (SELECT unnest(generate_series(DATE '2024-01-23', DATE '2024-02-01', INTERVAL 1 DAY)) AS d)
    LEFT JOIN (SELECT settlementdate::DATE AS k, count(*) AS n FROM a_price GROUP BY 1) ON k = d::DATE
    WHERE coalesce(n, 0) < 400 * 0.8""")
def _(spark, sf):
    def result(rows):
        return rows.groupBy(F.to_date("settlementdate").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))

    rows = base.a_price(spark, sf).select("event_id", "ts", "settlementdate")
    day = F.to_date("settlementdate")
    counts = corrected(spark, rows, (F.col("event_id") % 3 == 0), shared_folder(spark, "late-coverage"), {"day": day}, day, result)
    return jobs.thin(counts, "2024-02-02", 10, 400)


@query("compact_versions", """
    SELECT settlementdate::DATE AS day, count(*) AS n_rows, true AS bounded FROM a_price GROUP BY 1""")
def _(spark, sf):
    """Rows and versions merged while batches go on; the folders left follow the logarithm of their number."""
    def result(rows):
        return rows.groupBy(F.to_date("settlementdate").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))

    rows = base.a_price(spark, sf).select("event_id", "ts", "settlementdate").repartition(4)
    day, root = F.to_date("settlementdate"), shared_folder(spark, "compact")
    counts = corrected(spark, rows, (F.col("event_id") % 3 == 0), root, {"day": day}, day, result, compacted=True)
    left = len(corrections.current(spark, f"{root}/out"))
    return counts.select("day", "n_rows", F.lit(left <= 4).alias("bounded"))
