"""Point-in-time core: cleanup, as-of selection, region-days, feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base
from checks.base import PARAMS, query, rnd, rounded
from tidemark.functions import physical, provenance, timeaxis
from tidemark.operators import asof, asofjoin, clean, daily
from tidemark.plans import features as plan
from tidemark.session import materialised

OUTCOME = (["actual_max_rrp", "actual_mean_rrp", "actual_min_rrp"],
           ["regionid", "trading_day", "actual_n_over_300", "actual_n_negative", "spike", "n_intervals"])
SNAP_D = ["max_rrp", "mean_rrp", "p90_rrp", "max_demand", "mean_demand", "min_margin", "mean_margin", "min_wind",
          "mean_wind", "max_solar", "mean_load_bid"]
SNAP_N = ["n_over_300", "n_negative", "n_periods"]
FEATURE_INTS = ["regionid", "trading_day", "spike", "actual_n_over_300", "ev_n_over_300", "ev_n_negative",
                "spike_yesterday", "spike_count_7d", "dow", "month", "is_weekend", "season"]
FEATURE_DOUBLES = [c for c in plan.feature_columns() if c not in FEATURE_INTS]
FEATURES_SQL = rounded("features", FEATURE_DOUBLES, FEATURE_INTS)


def outcome(spark, sf):
    return daily.daily_outcome(base.price_final(spark, sf), expected=20, exact=False)


def features(spark, sf, params=PARAMS):
    return plan.build_features(base.price_final(spark, sf), base.state_final(spark, sf),
                               base.forecast(spark, sf), params)


@query("scan_pruned", "SELECT regionid, settlementdate, rrp FROM a_price")
def _(spark, sf):
    return base.a_price(spark, sf).select("regionid", "settlementdate", "rrp")


@query("price_final", "SELECT * FROM price_final")
def _(spark, sf):
    return base.price_final(spark, sf)


@query("regionsum_final", "SELECT * FROM state_final")
def _(spark, sf):
    return base.state_final(spark, sf)


@query("trading_day", "SELECT event_id, (ts - INTERVAL 245 MINUTE)::DATE AS trading_day FROM events")
def _(spark, sf):
    return base.events(spark, sf).select("event_id", timeaxis.trading_day(F.col("ts")).alias("trading_day"))


@query("trading_day_bounds", """
    SELECT min(d) AS first_day, max(d) AS last_day, min(d)::TIMESTAMP + INTERVAL 245 MINUTE AS first_label,
      (max(d) + 1)::TIMESTAMP + INTERVAL 240 MINUTE AS last_label
    FROM (SELECT (settlementdate - INTERVAL 245 MINUTE)::DATE AS d FROM a_price)""")
def _(spark, sf):
    from tidemark.operators import explore
    return explore.day_range(base.a_price(spark, sf))


@query("trading_days_filter", """
    SELECT event_id, rrp FROM a_price
    WHERE (settlementdate - INTERVAL 245 MINUTE)::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def _(spark, sf):
    return timeaxis.trading_days(base.a_price(spark, sf), "settlementdate", "2024-01-10", "2024-01-12").select(
        "event_id", "rrp")


@query("filter_pricing_run", """
    SELECT event_id, regionid, settlementdate, rrp FROM a_price
    WHERE intervention = 0 AND regionid IN ('SA1', 'VIC1')
      AND settlementdate >= TIMESTAMP '2024-01-05' AND settlementdate < TIMESTAMP '2024-01-20'""")
def _(spark, sf):
    from tidemark.operators import serving
    from tidemark.specs import SPECS
    rows = serving.range_read(base.a_price(spark, sf), SPECS["dispatchprice"], "2024-01-05", "2024-01-20")
    return clean.pricing_run(rows).where(F.col("regionid").isin("SA1", "VIC1")).select(
        "event_id", "regionid", "settlementdate", "rrp")


@query("exclude_administered", """
    SELECT event_id, rrp FROM a_price WHERE apcflag = 0 AND marketsuspendedflag = 0""")
def _(spark, sf):
    return clean.exclude_administered(base.a_price(spark, sf)).select("event_id", "rrp")


@query("margin", "SELECT event_id, availablegeneration - totaldemand AS margin FROM a_state")
def _(spark, sf):
    return base.a_state(spark, sf).select("event_id", physical.margin(
        F.col("availablegeneration"), F.col("totaldemand")).alias("margin"))


@query("derived_physical", """
    SELECT event_id, clearedsupply - initialsupply AS ramp, uigf - semischedule_clearedmw AS curtailment,
      totalintermittentgeneration - uigf AS intermittent_error FROM a_state""")
def _(spark, sf):
    return base.a_state(spark, sf).select("event_id", *[c.alias(n) for n, c in physical.derived_physical().items()])


@query("sensitivity_spread", """
    SELECT event_id, v, round(greatest(rrp1, rrp2, rrp3, rrp4, rrp5, rrp6, rrp7, rrp8)
      - least(rrp1, rrp2, rrp3, rrp4, rrp5, rrp6, rrp7, rrp8), 9) AS spread FROM a_fc_price""")
def _(spark, sf):
    return rnd(base.a_fc_price(spark, sf).select("event_id", "v", physical.sensitivity_spread().alias("spread")))


@query("clip_values", "SELECT event_id, least(greatest(rrp, -200), 2000) AS clipped FROM a_price")
def _(spark, sf):
    return base.a_price(spark, sf).select("event_id", physical.clip(F.col("rrp")).alias("clipped"))


@query("hours_from_start", """
    SELECT event_id, date_diff('microsecond', d::TIMESTAMP + INTERVAL 245 MINUTE, ts) / 3.6e9 AS hours
    FROM (SELECT event_id, ts, (ts - INTERVAL 245 MINUTE)::DATE AS d FROM events)""")
def _(spark, sf):
    t = F.col("ts")
    return base.events(spark, sf).select(
        "event_id", timeaxis.hours_from_start(t, timeaxis.trading_day(t)).alias("hours"))


@query("period_code", """
    SELECT event_id, strftime(d, '%Y%m%d') || lpad((p + 1)::VARCHAR, 3, '0') AS code,
      d::TIMESTAMP + INTERVAL 245 MINUTE + INTERVAL 5 MINUTE * p AS label
    FROM (SELECT event_id, d, (datediff('minute', d::TIMESTAMP + INTERVAL 245 MINUTE, t) // 5)::INT AS p
          FROM (SELECT event_id, date_trunc('minute', ts) AS t, (ts - INTERVAL 245 MINUTE)::DATE AS d FROM events))""")
def _(spark, sf):
    coded = base.events(spark, sf).select(
        "event_id", timeaxis.period_code(F.date_trunc("minute", "ts").cast("timestamp_ntz")).alias("code"))
    return coded.withColumn("label", timeaxis.period_label(F.col("code")))


@query("run_calendar", """
    SELECT event_id, v, run_datetime::DATE AS run_day,
      datediff('minute', run_datetime::DATE::TIMESTAMP, date_trunc('minute', run_datetime)) AS run_minute,
      (datetime - INTERVAL 245 MINUTE)::DATE AS target_day FROM a_fc_price""")
def _(spark, sf):
    return base.a_fc_price(spark, sf).select("event_id", "v", *[
        c.alias(n) for n, c in timeaxis.run_calendar(F.col("run_datetime"), F.col("datetime")).items()])


@query("calendar_features", """
    SELECT event_id, isodow(d)::INT AS dow, month(d)::INT AS month, CAST(isodow(d) >= 6 AS INT) AS is_weekend,
      CASE WHEN month(d) IN (12, 1, 2) THEN 'summer' WHEN month(d) IN (6, 7, 8) THEN 'winter'
           ELSE 'shoulder' END AS season
    FROM (SELECT o_orderkey AS event_id, o_orderdate::DATE AS d FROM orders)""")
def _(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return base.table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), *[
        c.alias(n) for n, c in timeaxis.calendar_columns(day).items()])


@query("known_at_filter", """
    SELECT regionid, datetime, vintage, source FROM forecast
    WHERE coalesce(known_at, run_datetime - INTERVAL 30 MINUTE) <= (trading_day - 1)::TIMESTAMP + INTERVAL 20 HOUR""")
def _(spark, sf):
    return asof.known_by(base.forecast(spark, sf), 20).select("regionid", "datetime", "vintage", "source")


@query("forecast_join", "SELECT * FROM forecast")
def _(spark, sf):
    return base.forecast(spark, sf)


@query("asof_latest", """
    SELECT 'ev' AS cutoff, regionid, datetime, vintage, rrp FROM asof_2000
    UNION ALL SELECT 'fc', regionid, datetime, vintage, rrp FROM asof_1300""")
def _(spark, sf):
    picked = asof.forecast_asof(base.forecast(spark, sf), {"ev": 20, "fc": 13}, ["vintage", "rrp"])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("cutoff"), F.col(n).alias("row")) for n in ("ev", "fc")]))
    return (picked.select("regionid", "datetime", pairs.alias("p")).where(F.col("p.row").isNotNull())
            .select("p.cutoff", "regionid", "datetime", "p.row.vintage", "p.row.rrp"))


@query("forecast_2000", rounded("forecast_2000", [f"ev_{m}" for m in SNAP_D],
                                ["regionid", "trading_day", *[f"ev_{m}" for m in SNAP_N]]))
def _(spark, sf):
    return rnd(asof.snapshot(base.forecast(spark, sf), "ev", 20, 20))


@query("forecast_1300", rounded("forecast_1300", [f"fc_{m}" for m in SNAP_D],
                                ["regionid", "trading_day", *[f"fc_{m}" for m in SNAP_N]]))
def _(spark, sf):
    return rnd(asof.snapshot(base.forecast(spark, sf), "fc", 13, 20))


@query("p90", """
    SELECT regionid, trading_day, round(quantile_cont(rrp, 0.9), 9) AS p90_rrp FROM price_final GROUP BY ALL""")
def _(spark, sf):
    return rnd(base.price_final(spark, sf).groupBy("regionid", "trading_day").agg(
        F.percentile("rrp", F.lit(0.9)).alias("p90_rrp")))


@query("daily_outcome", rounded("daily_outcome", *OUTCOME))
def _(spark, sf):
    return rnd(outcome(spark, sf))


@query("daily_state", rounded("daily_state", ["actual_max_demand", "actual_mean_demand", "actual_min_margin",
                                              "actual_mean_load_bid"], ["regionid", "trading_day"]))
def _(spark, sf):
    return rnd(daily.daily_state(base.state_final(spark, sf)))


@query("persistence", "SELECT * FROM persistence")
def _(spark, sf):
    return daily.persistence(outcome(spark, sf))


@query("yesterday_join", """
    SELECT o.regionid, o.trading_day, y.spike AS spike_yesterday, y.actual_max_rrp AS max_rrp_yesterday
    FROM daily_outcome o LEFT JOIN daily_outcome y
      ON o.regionid = y.regionid AND y.trading_day = o.trading_day - 1""")
def _(spark, sf):
    o = outcome(spark, sf)
    return daily.join_yesterday(o.select("regionid", "trading_day"), o, {
        "spike": "spike_yesterday", "actual_max_rrp": "max_rrp_yesterday"})


@query("persistence_join", """
    SELECT o.regionid, o.trading_day, o.spike, p.spike_count_7d, p.max_rrp_7d
    FROM daily_outcome o LEFT JOIN persistence p ON o.regionid = p.regionid AND o.trading_day = p.trading_day""")
def _(spark, sf):
    o = outcome(spark, sf)
    return o.select("regionid", "trading_day", "spike").join(
        daily.persistence(o), ["regionid", "trading_day"], "left")


@query("day_history", """
    SELECT o.regionid, o.trading_day, y.spike AS spike_yesterday, y.actual_max_rrp AS max_rrp_yesterday,
      p.spike_count_7d, p.max_rrp_7d
    FROM daily_outcome o
    LEFT JOIN daily_outcome y ON o.regionid = y.regionid AND y.trading_day = o.trading_day - 1
    LEFT JOIN persistence p ON o.regionid = p.regionid AND o.trading_day = p.trading_day""")
def _(spark, sf):
    return daily.with_history(outcome(spark, sf)).select(
        "regionid", "trading_day", "spike_yesterday", "max_rrp_yesterday", "spike_count_7d", "max_rrp_7d")


@query("feature_join_inner", """
    SELECT o.regionid, o.trading_day, o.spike, e.ev_n_periods, f.fc_n_periods FROM daily_outcome o
    JOIN forecast_2000 e ON o.regionid = e.regionid AND o.trading_day = e.trading_day
    JOIN forecast_1300 f ON o.regionid = f.regionid AND o.trading_day = f.trading_day""")
def _(spark, sf):
    fc = base.forecast(spark, sf)
    return plan.assemble(outcome(spark, sf), asof.snapshot(fc, "ev", 20, 20), asof.snapshot(fc, "fc", 13, 20)).select(
        "regionid", "trading_day", "spike", "ev_n_periods", "fc_n_periods")


@query("revisions", rounded("features", ["rev_max_rrp", "rev_min_wind", "rev_max_demand", "rev_min_margin"],
                            ["regionid", "trading_day"]))
def _(spark, sf):
    known = asof.snapshots(base.forecast(spark, sf), {"fc": 13, "ev": 20}, 20)
    rows = known.join(outcome(spark, sf).select("regionid", "trading_day"), ["regionid", "trading_day"], "left_semi")
    return rnd(rows.select("regionid", "trading_day", *[c.alias(n) for n, c in plan.revisions().items()]))


@query("ratios", """
    SELECT regionid, trading_day, round(ev_min_margin / nullif(ev_max_demand, 0), 9) AS ev_margin_ratio,
      round(ev_mean_wind / nullif(ev_mean_demand, 0), 9) AS ev_wind_ratio,
      round(ev_mean_load_bid / nullif(ev_mean_demand, 0), 9) AS ev_load_bid_ratio FROM forecast_2000""")
def _(spark, sf):
    known = asof.snapshot(base.forecast(spark, sf), "ev", 20, 20)
    return rnd(known.select("regionid", "trading_day", *[c.alias(n) for n, c in plan.ratios().items()]))


@query("features", FEATURES_SQL)
def _(spark, sf):
    return rnd(features(spark, sf))


@query("forecast_join_runlabel", "SELECT * FROM runs")
def _(spark, sf):
    return base.runs(spark, sf)


@query("asof_run", "SELECT regionid, datetime, run_datetime, rrp FROM run_1300")
def _(spark, sf):
    return asof.asof_run(base.runs(spark, sf), 13).select("regionid", "datetime", "run_datetime", "rrp")


LEGACY_DOUBLES = [f"fc_{m}" for m in SNAP_D] + ["am_max_rrp", "am_min_wind", "am_max_demand", "actual_max_rrp",
                                               "actual_mean_rrp", "actual_min_rrp", "rev_max_rrp", "rev_min_wind",
                                               "rev_max_demand"]
LEGACY_OTHERS = ["regionid", "trading_day", "spike", "fc_n_over_300", "fc_n_negative", "dow", "month", "is_weekend",
                 "season"]


@query("features_legacy", rounded("""(
    SELECT o.regionid, o.trading_day, o.actual_max_rrp, o.actual_mean_rrp, o.actual_min_rrp, o.spike,
      f.* EXCLUDE (regionid, trading_day, fc_n_periods), a.am_max_rrp, a.am_min_wind, a.am_max_demand,
      f.fc_max_rrp - a.am_max_rrp AS rev_max_rrp, f.fc_min_wind - a.am_min_wind AS rev_min_wind,
      f.fc_max_demand - a.am_max_demand AS rev_max_demand,
      (isodow(o.trading_day) - 1)::INT AS dow, month(o.trading_day)::INT AS month,
      CAST(isodow(o.trading_day) >= 6 AS INT) AS is_weekend,
      CASE WHEN month(o.trading_day) IN (12, 1, 2) THEN 'summer'
           WHEN month(o.trading_day) IN (6, 7, 8) THEN 'winter' ELSE 'shoulder' END AS season
    FROM daily_outcome o JOIN day_1300 f ON o.regionid = f.regionid AND o.trading_day = f.trading_day
    LEFT JOIN day_2000 a ON o.regionid = a.regionid AND o.trading_day = a.trading_day)""",
       LEGACY_DOUBLES, LEGACY_OTHERS))
def _(spark, sf):
    return rnd(plan.build_features_by_run(base.price_final(spark, sf), base.runs(spark, sf), PARAMS))


@query("feature_join_legacy", """
    SELECT o.regionid, o.trading_day, o.spike, f.fc_n_periods, a.am_n_periods FROM daily_outcome o
    JOIN day_1300 f ON o.regionid = f.regionid AND o.trading_day = f.trading_day
    LEFT JOIN day_2000 a ON o.regionid = a.regionid AND o.trading_day = a.trading_day""")
def _(spark, sf):
    runs = base.runs(spark, sf)
    keys = ["regionid", "trading_day"]

    def day(prefix, hours, least):
        rows = asof.asof_run(runs, hours)
        return asof.snapshot_features(rows, prefix, least, day="target_day").select(*keys, f"{prefix}_n_periods")

    return (outcome(spark, sf).select(*keys, "spike").join(day("fc", 13, 20), keys)
            .join(day("am", 20, 0), keys, "left"))


@query("run_label", """
    SELECT event_id, v, lastchanged, CASE WHEN lastchanged IS NOT NULL THEN
      min(datetime) OVER (PARTITION BY lastchanged) END AS run_label, lastchanged AS run_written_at
    FROM a_fc_price""")
def _(spark, sf):
    rows = base.a_fc_price(spark, sf).select("event_id", "v", "lastchanged", "datetime")
    return clean.label_runs(rows).select("event_id", "v", "lastchanged", F.col("run_datetime").alias("run_label"),
                                         "run_written_at")


@query("chrono_split", """
    SELECT regionid, trading_day, CASE WHEN trading_day < DATE '2024-01-15' THEN 'train'
      WHEN trading_day < DATE '2024-01-17' THEN 'embargo' WHEN trading_day < DATE '2024-01-23' THEN 'validation'
      WHEN trading_day < DATE '2024-01-25' THEN 'embargo' ELSE 'test' END AS split
    FROM features""")
def _(spark, sf):
    return plan.chrono_split(features(spark, sf), "2024-01-15", "2024-01-23", 2).select(
        "regionid", "trading_day", "split")


@query("safe_columns", rounded("features", [c for c in FEATURE_DOUBLES if not c.startswith("actual_")],
                               [c for c in FEATURE_INTS if not c.startswith("actual_")]))
def _(spark, sf):
    from tidemark.operators import catalog
    return rnd(catalog.safe_columns(features(spark, sf), catalog.dictionary(spark), "features"))


@query("actuals_join", """
    SELECT p.settlementdate, p.regionid, p.rrp, s.totaldemand, s.margin FROM price_final p
    JOIN state_final s ON p.settlementdate = s.settlementdate AND p.regionid = s.regionid""")
def _(spark, sf):
    cols = ["settlementdate", "regionid"]
    return clean.actuals(base.price_final(spark, sf).select(*cols, "rrp"),
                         base.state_final(spark, sf).select(*cols, "totaldemand", "margin"))


@query("vintage_trace", """
    SELECT f.regionid, f.datetime, f.run_datetime, f.vintage, f.rrp, p.rrp AS actual_rrp
    FROM (SELECT * FROM a_fc_price WHERE regionid = 'SA1' AND datetime = TIMESTAMP '2024-01-15 18:00:00') f
    LEFT JOIN price_final p ON p.regionid = f.regionid AND p.settlementdate = f.datetime""")
def _(spark, sf):
    when = F.lit("2024-01-15 18:00:00").cast("timestamp_ntz")
    return asof.vintage_trace(base.a_fc_price(spark, sf), base.price_final(spark, sf), "SA1", when)


@query("tumble_30m", """
    SELECT regionid, bucket_end, round(avg(rrp), 9) AS mean_rrp, count(*) AS n_intervals
    FROM (SELECT regionid, rrp, time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 1 MICROSECOND) + INTERVAL 30 MINUTE
            AS bucket_end FROM a_price WHERE intervention = 0) GROUP BY ALL""")
def _(spark, sf):
    from tidemark.operators import explore
    rows = clean.pricing_run(base.a_price(spark, sf))
    return rnd(explore.tumble(rows, "ts", ["regionid"], [F.avg("rrp").alias("mean_rrp"),
                                                        F.count(F.lit(1)).alias("n_intervals")]))


@query("downsample_compare", """
    SELECT f.regionid, f.datetime, f.rrp AS forecast_rrp, round(a.actual_rrp, 9) AS actual_rrp, a.n_intervals
    FROM asof_2000 f JOIN (
      SELECT regionid, bucket_end, avg(rrp) AS actual_rrp, count(*) AS n_intervals
      FROM (SELECT regionid, rrp, time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 1 MICROSECOND)
              + INTERVAL 30 MINUTE AS bucket_end FROM a_price WHERE intervention = 0) GROUP BY ALL) a
    ON f.regionid = a.regionid AND f.datetime = a.bucket_end""")
def _(spark, sf):
    from tidemark.operators import explore
    picked = asof.unpack(asof.forecast_asof(base.forecast(spark, sf), {"ev": 20}, ["rrp"]), "ev")
    actual = clean.pricing_run(base.a_price(spark, sf)).select("regionid", F.col("ts").alias("settlementdate"), "rrp")
    return rnd(explore.downsample_compare(
        picked.select("regionid", "datetime", F.col("rrp").alias("forecast_rrp")), actual))


@query("asof_join", """
    WITH known AS (SELECT regionid, known_at, arg_max({'rrp': rrp, 'price_event': event_id}, event_id) AS v
                   FROM a_price WHERE intervention = 0 GROUP BY ALL)
    SELECT p.event_id, p.regionid, p.ts, v.rrp AS known_rrp, v.price_event AS known_event
    FROM a_price p ASOF LEFT JOIN known ON p.regionid = known.regionid AND p.ts >= known.known_at""")
def _(spark, sf):
    """Every event beside the newest price of its region that was published by then; each row has its own cutoff."""
    p = base.a_price(spark, sf)
    known = clean.pricing_run(p).select("regionid", "known_at", F.col("rrp").alias("known_rrp"), F.col("event_id").alias("known_event"))
    return asofjoin.asof_join(p.select("event_id", "regionid", "ts"), known, ["regionid"], "ts", "known_at",
                              ["known_rrp", "known_event"], ["known_event"])


@query("asof_join_cutoffs", """
    WITH cutoffs AS (SELECT DISTINCT regionid, datetime, (trading_day - 1)::TIMESTAMP + to_hours(h) AS cutoff, h AS hours
                     FROM forecast, (SELECT unnest([6, 13, 20, 23]) AS h)),
    known AS (SELECT regionid, datetime, coalesce(known_at, run_datetime - INTERVAL 30 MINUTE) AS known,
                arg_max({'vintage': vintage, 'rrp': rrp}, (vintage, -list_position(['mmsdm', 'report_archive', 'report_current'], source))) AS v
              FROM forecast GROUP BY ALL)
    SELECT c.regionid, c.datetime, c.hours, v.vintage AS vintage, v.rrp AS rrp
    FROM cutoffs c ASOF LEFT JOIN known k ON c.regionid = k.regionid AND c.datetime = k.datetime AND c.cutoff >= k.known""")
def _(spark, sf):
    """Cutoffs that come from a table: any number for an interval, without one pass or column for each."""
    fc = base.forecast(spark, sf)
    steps = (6, 13, 20, 23)

    def cutoff(h):
        return timeaxis.ntz(F.date_sub("trading_day", 1)) + F.make_dt_interval(hours=h)

    known = fc.select("regionid", "datetime", "trading_day", asof.knowledge().alias("known"), "vintage", "rrp",
                      (-provenance.source_rank(F.col("source"))).alias("trust"))
    # The forecasts are joined once; what cutoffs can meet is small beside them and read twice.
    known = materialised(asofjoin.newest_between(known, ["regionid", "datetime", "trading_day"], "known",
                                                 [cutoff(F.lit(h)) for h in steps], ["vintage", "rrp"], ["vintage", "trust"]))
    hours = F.explode(F.array(*[F.lit(h) for h in steps])).alias("hours")
    cutoffs = known.select("regionid", "datetime", "trading_day").distinct().select("*", hours)
    cutoffs = cutoffs.select("regionid", "datetime", "hours", cutoff(F.col("hours")).alias("cutoff"))
    return asofjoin.asof_join(cutoffs, known, ["regionid", "datetime"], "cutoff", "known", ["vintage", "rrp"],
                              ["vintage", "trust"]).drop("cutoff")
