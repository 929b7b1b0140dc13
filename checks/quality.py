"""Coverage, profiles, distributions and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base
from checks.base import query, rnd
from checks.points import features, outcome
from tidemark import fixed_values as fv
from tidemark.operators import clean, daily, evaluate, explore, quality, sketches
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans import warehouse
from tidemark.plans.quality_report import quality_report
from tidemark.session import shared_folder


def priced(spark, sf):
    return clean.pricing_run(base.a_price(spark, sf))


@query("conditional_counts", """
    SELECT regionid, source, count(*) FILTER (WHERE rrp > 300) AS n_over,
      count(*) FILTER (WHERE rrp < 0) AS n_negative, count(*) FILTER (WHERE apcflag = 1) AS n_capped
    FROM a_price GROUP BY ALL""")
def _(spark, sf):
    return quality.conditional_counts(base.a_price(spark, sf), ["regionid", "source"], {
        "n_over": F.col("rrp") > 300, "n_negative": F.col("rrp") < 0, "n_capped": F.col("apcflag") == 1})


@query("spike_rate_by_region", """
    SELECT regionid, count(*) AS days, min(trading_day) AS first_day, max(trading_day) AS last_day,
      round(avg(spike), 3) AS spike_rate FROM features GROUP BY regionid""")
def _(spark, sf):
    return quality.spike_rate_by_region(features(spark, sf))


@query("spike_rate_by_quarter", """
    SELECT date_trunc('quarter', trading_day)::DATE AS quarter,
      round(avg(spike) FILTER (WHERE regionid = 'NSW1'), 2) AS nsw,
      round(avg(spike) FILTER (WHERE regionid = 'QLD1'), 2) AS qld,
      round(avg(spike) FILTER (WHERE regionid = 'SA1'), 2) AS sa,
      round(avg(spike) FILTER (WHERE regionid = 'TAS1'), 2) AS tas,
      round(avg(spike) FILTER (WHERE regionid = 'VIC1'), 2) AS vic FROM features GROUP BY 1""")
def _(spark, sf):
    return quality.spike_rate_by_quarter(features(spark, sf))


CONFUSION = """
    count(*) FILTER (WHERE spike = 1 AND ev_max_rrp > 300) AS tp,
    count(*) FILTER (WHERE spike = 0 AND ev_max_rrp > 300) AS fp,
    count(*) FILTER (WHERE spike = 1 AND ev_max_rrp <= 300) AS fn,
    count(*) FILTER (WHERE spike = 0 AND ev_max_rrp <= 300) AS tn, count(*) AS n"""
RATES = """tp, fp, fn, tn, n, round(tp / nullif(tp + fp, 0), 3) AS precision,
    round(tp / nullif(tp + fn, 0), 3) AS recall, round((tp + tn) / n, 3) AS accuracy"""
PERIOD = """CASE WHEN trading_day < DATE '2025-01-01' THEN '2023-24'
    WHEN trading_day < DATE '2026-01-01' THEN '2025' ELSE '2026' END"""


@query("benchmark_by_period", f"""
    SELECT period, {RATES} FROM (SELECT {PERIOD} AS period, {CONFUSION} FROM features GROUP BY 1)""")
def _(spark, sf):
    return evaluate.evaluate_rule(features(spark, sf), by=[
        evaluate.benchmark_period(F.col("trading_day")).alias("period")])


@query("benchmark_by_region", f"SELECT regionid, {RATES} FROM (SELECT regionid, {CONFUSION} FROM features GROUP BY 1)")
def _(spark, sf):
    return evaluate.evaluate_rule(features(spark, sf), by=["regionid"])


@query("benchmark_overall", f"SELECT {RATES} FROM (SELECT {CONFUSION} FROM features)")
def _(spark, sf):
    return evaluate.evaluate_rule(features(spark, sf))


@query("crosstab", """
    SELECT spike AS label, count(*) FILTER (WHERE NOT ev_max_rrp > 300) AS call_0,
      count(*) FILTER (WHERE ev_max_rrp > 300) AS call_1 FROM features GROUP BY spike""")
def _(spark, sf):
    return evaluate.crosstab(features(spark, sf), "spike", F.col("ev_max_rrp") > 300)


@query("coverage_by_year", """
    SELECT year(trading_day)::INT AS year, count(*) AS region_days, count(DISTINCT trading_day) AS days,
      round(count(*) / 5, 0) AS days_per_region FROM features GROUP BY 1""")
def _(spark, sf):
    return quality.coverage_by_year(features(spark, sf))


@query("null_audit", """
    SELECT count(*) FILTER (WHERE spike_yesterday IS NULL) AS no_yesterday,
      count(*) FILTER (WHERE spike_count_7d IS NULL) AS no_7d,
      count(*) FILTER (WHERE fc_max_rrp IS NULL) AS no_1300_forecast,
      count(*) FILTER (WHERE ev_max_rrp IS NULL) AS no_2000_forecast, count(*) AS total FROM features""")
def _(spark, sf):
    return quality.null_audit(features(spark, sf))


def _report_part(check: str, subject: str, view: str, measures: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", {subject} AS subject, '{m}' AS measure, {m}::DOUBLE AS value FROM {view}"
        for m in measures)


@query("quality_report", "WITH by_region AS (SELECT regionid, count(*) AS days, round(avg(spike), 3) AS spike_rate"
       " FROM features GROUP BY 1), by_quarter AS (SELECT date_trunc('quarter', trading_day)::DATE AS quarter, "
       + ", ".join(f"round(avg(spike) FILTER (WHERE regionid = '{r}'), 2) AS {r.lower()[:-1]}" for r in fv.REGIONS)
       + f" FROM features GROUP BY 1), by_period AS (SELECT period, {RATES} FROM (SELECT {PERIOD} AS period, "
       f"{CONFUSION} FROM features GROUP BY 1)), by_year AS (SELECT year(trading_day) AS year, count(*) AS region_days,"
       " count(DISTINCT trading_day) AS days, round(count(*) / 5, 0) AS days_per_region FROM features GROUP BY 1),"
       " nulls AS (SELECT count(*) FILTER (WHERE spike_yesterday IS NULL) AS no_yesterday,"
       " count(*) FILTER (WHERE spike_count_7d IS NULL) AS no_7d,"
       " count(*) FILTER (WHERE fc_max_rrp IS NULL) AS no_1300_forecast,"
       " count(*) FILTER (WHERE ev_max_rrp IS NULL) AS no_2000_forecast, count(*) AS total FROM features) "
       + " UNION ALL ".join([
           _report_part("spike_rate", "regionid", "by_region", ["days", "spike_rate"]),
           _report_part("base_rate", "quarter::VARCHAR", "by_quarter", ["nsw", "qld", "vic", "sa", "tas"]),
           _report_part("benchmark", "period", "by_period", ["tp", "fp", "fn", "tn", "n", "precision", "recall",
                                                             "accuracy"]),
           _report_part("coverage", "year::VARCHAR", "by_year", ["region_days", "days", "days_per_region"]),
           _report_part("nulls", "'features'", "nulls", ["no_yesterday", "no_7d", "no_1300_forecast",
                                                         "no_2000_forecast", "total"])]))
def _(spark, sf):
    """The checks follow a stored build, so the table is built once and read five times."""
    path = shared_folder(spark, "built")
    warehouse.materialise(features(spark, sf), path)
    return quality_report(spark.read.parquet(path))


def four_tables(spark, sf):
    return {"dispatchprice": (base.a_price(spark, sf), "settlementdate"),
            "dispatchregionsum": (base.a_state(spark, sf), "settlementdate"),
            "predispatchprice": (base.a_fc_price(spark, sf), "datetime"),
            "predispatchregionsum": (base.a_fc_state(spark, sf), "datetime")}


FOUR = [("dispatchprice", "a_price", "settlementdate"), ("dispatchregionsum", "a_state", "settlementdate"),
        ("predispatchprice", "a_fc_price", "datetime"), ("predispatchregionsum", "a_fc_state", "datetime")]


@query("table_summary", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, source, count(*) AS n_rows, min({t}) AS first_interval, max({t}) AS last_interval"
    f" FROM {v} GROUP BY source" for n, v, t in FOUR))
def _(spark, sf):
    return quality.table_summary(four_tables(spark, sf))


@query("freshness", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, max({t}) AS latest_interval FROM {v}" for n, v, t in FOUR))
def _(spark, sf):
    return quality.freshness(four_tables(spark, sf))


@query("load_sanity", """
    SELECT min(settlementdate) AS first_interval, max(settlementdate) AS last_interval,
      round(min(rrp), 2) AS min_rrp, round(max(rrp), 2) AS max_rrp, count(DISTINCT regionid) AS regions FROM a_price""")
def _(spark, sf):
    return quality.load_sanity(base.a_price(spark, sf))


@query("rows_by_source", "SELECT source, count(*) AS n FROM a_price GROUP BY source")
def _(spark, sf):
    return quality.rows_by(base.a_price(spark, sf), "source")


@query("price_status_counts", "SELECT price_status, count(*) AS n FROM a_price GROUP BY price_status")
def _(spark, sf):
    return quality.price_status_counts(base.a_price(spark, sf))


@query("value_counts", "SELECT event_type, source, count(*) AS n FROM a_price GROUP BY ALL")
def _(spark, sf):
    return quality.rows_by(base.a_price(spark, sf), "event_type", "source")


@query("storage_stats", """
    SELECT 'lineitem' AS table_name, count(*) AS n_rows, true AS has_bytes, 1::BIGINT AS parts FROM lineitem""")
def _(spark, sf):
    stats = quality.storage_stats(base.table(spark, sf, "lineitem"), "lineitem")
    return stats.select("table_name", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"), "parts")


@query("thin_days", """
    SELECT d::DATE AS day, coalesce(n, 0) AS n_rows
    FROM (SELECT unnest(generate_series(DATE '2024-01-23', DATE '2024-02-01', INTERVAL 1 DAY)) AS d)
    LEFT JOIN (SELECT settlementdate::DATE AS k, count(*) AS n FROM a_price GROUP BY 1) ON k = d::DATE
    WHERE coalesce(n, 0) < 400 * 0.8""")
def _(spark, sf):
    return quality.thin_days(base.a_price(spark, sf), "settlementdate", "2024-02-02", 10, 400)


@query("price_day_stats", """
    SELECT regionid, min(rrp) AS min, round(avg(rrp), 9) AS mean, round(median(rrp), 9) AS median, max(rrp) AS max,
      count(*) FILTER (WHERE rrp > 300) AS n_over, count(*) FILTER (WHERE rrp < 0) AS n_negative,
      count(*) AS n_intervals
    FROM price_final WHERE trading_day = DATE '2024-01-15' GROUP BY regionid""")
def _(spark, sf):
    return rnd(explore.price_day_stats(base.price_final(spark, sf), "2024-01-15"))


@query("negative_share", """
    SELECT regionid, round(avg(CAST(rrp < 0 AS INT)), 9) AS negative_share, count(*) AS n
    FROM a_price WHERE intervention = 0 GROUP BY regionid""")
def _(spark, sf):
    return rnd(explore.negative_share(priced(spark, sf)))


@query("price_histogram", """
    SELECT regionid, least(floor((rrp + 200) / 3.5)::INT + 1, 200) AS bin, count(*) AS n
    FROM a_price WHERE intervention = 0 AND rrp BETWEEN -200 AND 500 GROUP BY ALL""")
def _(spark, sf):
    return explore.histogram(priced(spark, sf), "rrp", ["regionid"])


@query("median_by_hour_season", """
    SELECT regionid, CASE WHEN month(settlementdate) IN (12, 1, 2) THEN 'summer'
      WHEN month(settlementdate) IN (6, 7, 8) THEN 'winter' ELSE 'shoulder' END AS season,
      hour(settlementdate)::INT AS hour, round(median(rrp), 9) AS median_rrp, count(*) AS n
    FROM price_final GROUP BY ALL""")
def _(spark, sf):
    return rnd(explore.median_by_hour_season(base.price_final(spark, sf)))


@query("quantile_bins", """
    WITH e AS (SELECT list_distinct(list(q)) AS edges FROM (
        SELECT unnest(quantile_cont(l_extendedprice, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS q
        FROM lineitem))
    SELECT bin::INT AS bin, round(avg(l_quantity), 6) AS mean, min(l_extendedprice) AS lowest,
      max(l_extendedprice) AS highest, count(*) AS n, median(l_quantity) AS median
    FROM (SELECT l_quantity, l_extendedprice,
            greatest(len(list_filter(edges, lambda x: x < l_extendedprice)), 1) AS bin
          FROM lineitem CROSS JOIN e) GROUP BY bin""")
def _(spark, sf):
    return rnd(explore.quantile_bins(base.table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity"), 6)


@query("exceedance", """
    SELECT regionid, threshold::DOUBLE AS threshold, count(rrp) AS n,
      count(*) FILTER (WHERE rrp > threshold) AS n_over,
      100 * count(*) FILTER (WHERE rrp > threshold) / count(rrp) AS pct
    FROM a_price CROSS JOIN (SELECT unnest([100, 200, 300, 500, 1000, 5000]) AS threshold)
    WHERE intervention = 0 GROUP BY regionid, threshold""")
def _(spark, sf):
    return explore.exceedance(priced(spark, sf), ["regionid"])


@query("daily_spike_rate", """
    SELECT regionid, round(avg(CAST(m > 300 AS INT)), 9) AS spike_rate, count(*) AS days
    FROM (SELECT regionid, settlementdate::DATE AS day, max(rrp) AS m FROM price_final GROUP BY ALL) GROUP BY regionid""")
def _(spark, sf):
    return rnd(explore.daily_spike_rate(base.price_final(spark, sf)))


STATE_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "regionid": "string", "settlementdate": "timestamp_ntz",
               "intervention": "int", "source": "string", "known_at": "timestamp_ntz",
               **{c: "double" for c in ("totaldemand", "availablegeneration", "availableload", "demandforecast",
                                        "netinterchange", "initialsupply", "clearedsupply", "uigf",
                                        "semischedule_clearedmw", "totalintermittentgeneration")}}


@query("profile_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,"
    f" count(DISTINCT {c}) AS n_distinct, '{t}' AS dtype FROM a_state" for c, t in STATE_TYPES.items()))
def _(spark, sf):
    return quality.profile_columns(base.a_state(spark, sf))


DESCRIBED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,"
    f" round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS p25,"
    f" round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75 FROM lineitem"
    for c in DESCRIBED))
def _(spark, sf):
    return rnd(quality.describe_numeric(base.table(spark, sf, "lineitem")), 4)


FORECAST_COLUMNS = ["event_id", "v", "regionid", "datetime", "run_datetime", "vintage", "known_at", "lastchanged", "source",
                    "intervention", "rrp", *[f"rrp{i}" for i in range(1, 9)]]


@query("null_fraction", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS INT)), 9) AS null_fraction FROM a_fc_price"
    for c in FORECAST_COLUMNS) + ") ORDER BY null_fraction DESC, column_name LIMIT 15")
def _(spark, sf):
    return rnd(quality.null_fraction(base.a_fc_price(spark, sf)))


@query("median_abs_error", """
    SELECT 'demand' AS measure, count(*) AS n, median(abs(demandforecast - totaldemand)) AS median_abs_error
    FROM a_state
    UNION ALL SELECT 'intermittent', count(totalintermittentgeneration),
      median(abs(totalintermittentgeneration - uigf)) FROM a_state""")
def _(spark, sf):
    return explore.median_abs_error(base.a_state(spark, sf), {
        "demand": (F.col("demandforecast"), F.col("totaldemand")),
        "intermittent": (F.col("totalintermittentgeneration"), F.col("uigf"))})


@query("duplicate_keys", """
    SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, (sum(n) - count(*))::BIGINT AS duplicates
    FROM (SELECT count(*) AS n FROM a_price GROUP BY regionid, settlementdate, intervention, source)""")
def _(spark, sf):
    return quality.duplicate_keys(base.a_price(spark, sf), ["regionid", "settlementdate", "intervention", "source"])


@query("join_alignment", """
    SELECT sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows, sum(l * r)::BIGINT AS joined_rows,
      sum(CASE WHEN r = 0 THEN l ELSE 0 END)::BIGINT AS left_only,
      sum(CASE WHEN l = 0 THEN r ELSE 0 END)::BIGINT AS right_only,
      count(*) FILTER (WHERE l > 1 OR r > 1) AS repeated_keys
    FROM (SELECT count(*) FILTER (WHERE side = 'l') AS l, count(*) FILTER (WHERE side = 'r') AS r
          FROM (SELECT run_datetime, datetime, regionid, 'l' AS side FROM a_fc_price WHERE intervention = 0
                UNION ALL SELECT run_datetime, datetime, regionid, 'r' FROM a_fc_state)
          GROUP BY run_datetime, datetime, regionid)""")
def _(spark, sf):
    return quality.join_alignment(clean.pricing_run(base.a_fc_price(spark, sf)), base.a_fc_state(spark, sf),
                                  ["run_datetime", "datetime", "regionid"])


@query("run_coverage", """
    SELECT datediff('day', run_day, target_day)::INT AS days_ahead, count(*) AS n FROM runs
    WHERE run_minute = 120 GROUP BY 1""")
def _(spark, sf):
    return quality.run_coverage(base.runs(spark, sf), 2)


@query("spike_autocorr", """
    SELECT o.regionid, round(corr(o.spike, y.spike), 9) AS lag1_corr, count(*) AS pairs FROM daily_outcome o
    JOIN daily_outcome y ON o.regionid = y.regionid AND y.trading_day = o.trading_day - 1 GROUP BY o.regionid""")
def _(spark, sf):
    return rnd(daily.spike_autocorrelation(outcome(spark, sf)))


@query("sample_rows", """
    SELECT event_id, regionid, rrp FROM price_rows ORDER BY md5(event_id || '|0'), event_id LIMIT 1000""".replace(
        "price_rows", "(SELECT event_id, regionid, rrp FROM a_price WHERE intervention = 0)"))
def _(spark, sf):
    """A thousand of all rows (or all, where there are fewer)."""
    return explore.sample_rows(priced(spark, sf).select("event_id", "regionid", "rrp"), 1000, ["event_id"])


SKETCHED = ["rrp", "event_id", "user_id", "price_status", "settlementdate"]


@query("profile_incremental", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, true AS distinct_close, "
    + ("true" if c != "price_status" else "NULL::BOOLEAN") + " AS median_close, 1::BIGINT AS days_read FROM a_price" for c in SKETCHED))
def _(spark, sf):
    """Sketches of all days but the last are stored, the last day alone is read and added, and the sum is compared with exact figures."""
    root = shared_folder(spark, "sketches")
    rows = base.a_price(spark, sf).select(*SKETCHED, F.to_date("ts").alias("day"))
    last = rows.agg(F.max("day")).first()[0]
    sketches.sketch(rows.where(F.col("day") < F.lit(last)), ["day"]).write.parquet(f"{root}/kept")
    fresh = sketches.sketch(rows.where(F.col("day") == F.lit(last)), ["day"])
    fresh.write.mode("append").parquet(f"{root}/kept")
    days = fresh.select("day").distinct().count()
    found = sketches.estimated(sketches.merged(spark.read.parquet(f"{root}/kept")), [0.5])
    exact = quality.profile_columns(rows.select(*SKETCHED)).select(F.col("column_name").alias("of"), F.col("n_distinct").alias("true_distinct"))
    # The estimated median must lie between the exact quantiles 0.47 and 0.53.
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), sketches._value(c, dict(rows.dtypes)[c]).alias("x"))
                                           for c in SKETCHED])).alias("e")).select("e.*")
    near = exact_quantiles(long, "x", [0.47, 0.53], ["name"]).select("name", "q")
    both = found.join(exact, F.col("column_name") == F.col("of")).join(near, F.col("column_name") == F.col("name"), "left")
    return both.select("column_name", "n_rows", "n_null",
                       (F.abs(F.col("n_distinct") - F.col("true_distinct")) <= 0.08 * F.col("true_distinct")).alias("distinct_close"),
                       F.col("quantiles")[0].between(F.col("q")[0], F.col("q")[1]).alias("median_close"),
                       F.lit(days).cast("bigint").alias("days_read"))
