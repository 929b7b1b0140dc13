"""Edges of the point-in-time rules on hand-made rows."""

import datetime as dt

import pytest
from conftest import same_rows, ts
from pyspark.sql import functions as F

from tidemark.functions import physical, provenance, timeaxis
from tidemark.operators import asof, clean, daily
from tidemark.plans import features as plan
from tidemark.specs import Params


def price_rows(spark, rows):
    """rows: (region, label, source, intervention, rrp)"""
    return spark.createDataFrame(
        [(r, ts(t), s, i, p, "FIRM", ts(t)) for r, t, s, i, p in rows],
        "regionid string, settlementdate timestamp_ntz, source string, intervention int, rrp double, "
        "price_status string, known_at timestamp_ntz")


@pytest.mark.parametrize("label,day", [("2024-01-02T04:00:00", "2024-01-01"), ("2024-01-02T04:05:00", "2024-01-02"),
                                       ("2024-01-02T00:00:00", "2024-01-01"), ("2024-01-02T23:55:00", "2024-01-02")])
def test_trading_day_edges(spark, label, day):
    df = spark.createDataFrame([(ts(label),)], "t timestamp_ntz")
    assert str(df.select(timeaxis.trading_day(F.col("t"))).first()[0]) == day


def test_day_bounds_and_period_codes(spark):
    day = F.lit("2024-02-15").cast("date")
    row = spark.range(1).select(timeaxis.day_start(day), timeaxis.day_end(day)).first()
    assert row[0] == ts("2024-02-15T04:05:00") and row[1] == ts("2024-02-16T04:00:00")
    df = spark.createDataFrame([(ts("2024-02-15T18:30:00"),), (ts("2024-02-16T00:00:00"),), (ts("2024-02-16T04:00:00"),)],
                               "t timestamp_ntz")
    coded = df.withColumn("c", timeaxis.period_code(F.col("t"))).withColumn("b", timeaxis.period_label(F.col("c")))
    rows = coded.collect()
    assert [r.c for r in rows] == ["20240215174", "20240215240", "20240215288"]  # 174 is 18:30, 240 is midnight
    assert all(r.b == r.t for r in rows)


def test_interval_end_bucket(spark):
    df = spark.createDataFrame([(ts(f"2024-01-01T{t}"),) for t in ("00:05:00", "00:30:00", "00:35:00")], "t timestamp_ntz")
    got = [r[0] for r in df.select(timeaxis.interval_end_bucket(F.col("t"))).collect()]
    assert got == [ts("2024-01-01T00:30:00"), ts("2024-01-01T00:30:00"), ts("2024-01-01T01:00:00")]


def test_source_precedence(spark):
    t = "2024-01-01T05:00:00"
    rows = [("SA1", t, s, 0, p) for s, p in (("report_current", 1.0), ("mmsdm", 2.0), ("report_archive", 3.0))]
    assert [r.rrp for r in clean.price_final(price_rows(spark, rows)).collect()] == [2.0]
    assert [r.rrp for r in clean.price_final(price_rows(spark, rows[::2])).collect()] == [3.0]


@pytest.mark.parametrize("path", ["aggregate", "window"])
def test_intervened_rows_never_win(spark, path):
    t = "2024-01-01T05:00:00"
    rows = [("SA1", t, "mmsdm", 1, 9.0), ("SA1", t, "report_current", 0, 1.0)]
    assert [r.rrp for r in clean.price_final(price_rows(spark, rows), path=path).collect()] == [1.0]


def test_first_by_paths_agree(spark):
    from checks import base
    p = base.a_price(spark, "/root/testdata/sf0.001")
    same_rows(clean.price_final(p, ["event_id"]), clean.price_final(p, ["event_id"], path="window"))


def day_of(spark, n, rrp=lambda i: 10.0, day="2024-01-01", region="SA1", step=5):
    start = ts(f"{day}T04:05:00")
    return [(region, (start + dt.timedelta(minutes=step * i)).isoformat(), "mmsdm", 0, rrp(i)) for i in range(n)]


def test_only_complete_days(spark):
    rows = day_of(spark, 288) + day_of(spark, 287, day="2024-01-02")
    got = daily.daily_outcome(clean.price_final(price_rows(spark, rows))).collect()
    assert [(str(r.trading_day), r.n_intervals) for r in got] == [("2024-01-01", 288)]


def test_threshold_edges(spark):
    def spike(values):
        rows = price_rows(spark, day_of(spark, 288, lambda i: values[i] if i < len(values) else 10.0))
        r = daily.daily_outcome(clean.price_final(rows)).first()
        return r.spike, r.actual_n_over_300, r.actual_n_negative

    assert spike([300.0, 0.0]) == (0, 0, 0)
    assert spike([300.01, -0.01]) == (1, 1, 1)


def days(spark, rows):
    return spark.createDataFrame([(r, dt.date.fromisoformat(d), s, m) for r, d, s, m in rows],
                                 "regionid string, trading_day date, spike int, actual_max_rrp double")


def test_rolling_frame_and_calendar_gap(spark):
    rows = [("SA1", f"2024-01-{d:02d}", d % 2, float(d)) for d in range(1, 12) if d != 9]
    df = days(spark, rows)
    week = {r.trading_day.day: r for r in daily.persistence(df).collect()}
    assert week[1].spike_count_7d is None and week[1].max_rrp_7d is None
    assert week[8].spike_count_7d == 4 and week[8].max_rrp_7d == 7.0
    assert week[10].max_rrp_7d == 8.0 and week[10].spike_count_7d == 3  # rows 2..8
    both = {r.trading_day.day: r for r in daily.with_history(df).collect()}
    assert both[10].spike_yesterday is None and both[11].spike_yesterday == 0 and both[2].max_rrp_yesterday == 1.0
    joined = {r.trading_day.day: r for r in daily.join_yesterday(
        df.select("regionid", "trading_day"), df, {"spike": "spike_yesterday"}).collect()}
    assert {d: r.spike_yesterday for d, r in joined.items()} == {d: r.spike_yesterday for d, r in both.items()}


VALUES = ["vintage", "rrp"]


def vintages(spark, rows):
    """rows: (label, vintage, known_at, run, rrp)"""
    return spark.createDataFrame(
        [("SA1", ts(t), v, "mmsdm", ts(k), ts(run), p) for t, v, k, run, p in rows],
        "regionid string, datetime timestamp_ntz, vintage string, source string, known_at timestamp_ntz, "
        "run_datetime timestamp_ntz, rrp double").withColumn("trading_day", timeaxis.trading_day(F.col("datetime")))


def picks(df, hours=20):
    fast = asof.unpack(asof.forecast_asof(df, {"ev": hours}, VALUES), "ev")
    cut = timeaxis.cutoff_before(F.col("trading_day"), hours)
    same_rows(fast, asof.asof_latest_window(df, asof.FORECAST_KEYS, asof.knowledge(), cut, asof.recency(df), VALUES))
    return [r.vintage for r in fast.collect()]


LABEL = "2024-01-10T12:00:00"  # trading day the 10th, decided at 20:00 on the 9th


def test_cutoff_is_inclusive(spark):
    rows = [(LABEL, "a", "2024-01-09T20:00:00", "2024-01-09T20:30:00", 1.0),
            (LABEL, "b", "2024-01-09T20:00:01", "2024-01-09T20:30:00", 2.0)]
    assert picks(vintages(spark, rows)) == ["a"]


def test_null_known_at_loses_but_counts_alone(spark):
    dated = (LABEL, "a", "2024-01-09T01:00:00", "2024-01-09T01:30:00", 1.0)
    null = (LABEL, "z", None, "2024-01-09T19:00:00", 2.0)
    assert picks(vintages(spark, [dated, null])) == ["a"]
    assert picks(vintages(spark, [null])) == ["z"]
    late = (LABEL, "z", None, "2024-01-09T20:31:00", 2.0)  # run label less 30 minutes is after the cutoff
    assert picks(vintages(spark, [late])) == []


def test_known_at_tie_takes_larger_vintage(spark):
    rows = [(LABEL, v, "2024-01-09T12:00:00", "2024-01-09T12:30:00", 1.0) for v in ("a", "c", "b")]
    assert picks(vintages(spark, rows)) == ["c"]


def test_min_periods(spark):
    def rows(n, day):
        return [((ts(f"{day}T04:30:00") + dt.timedelta(minutes=30 * i)).isoformat(), "a", "2024-01-08T00:00:00",
                 "2024-01-08T00:30:00", float(i)) for i in range(n)]

    df = vintages(spark, rows(39, "2024-01-10") + rows(40, "2024-01-12"))
    for c in ("totaldemand", "margin", "wind", "solar", "availableload"):
        df = df.withColumn(c, F.lit(1.0))
    got = asof.snapshot(df, "ev", 20).collect()
    assert [(str(r.trading_day), r.ev_n_periods, r.ev_p90_rrp) for r in got] == [
        ("2024-01-12", 40, pytest.approx(35.1))]


def test_intervened_forecast_does_not_fan_out(spark):
    price = spark.createDataFrame([("SA1", ts(LABEL), "v", "mmsdm", 0, None, ts(LABEL), 1.0)],
                                  "regionid string, datetime timestamp_ntz, vintage string, source string, intervention int, "
                                  "known_at timestamp_ntz, run_datetime timestamp_ntz, rrp double")
    state = spark.createDataFrame([("SA1", ts(LABEL), "v", "mmsdm", i, 1780.0, 1550.0, 90.0, 340.0, 340.0, 0.0)
                                   for i in (0, 1)],
                                  "regionid string, datetime timestamp_ntz, vintage string, source string, intervention int, "
                                  "totaldemand double, availablegeneration double, availableload double, uigf double, "
                                  "ss_wind_uigf double, ss_solar_uigf double")
    got = clean.forecast(price, state).collect()
    assert len(got) == 1 and got[0].margin == -230.0


def test_worked_interval(spark):
    df = spark.createDataFrame([(1762.0, 1780.0, 340.0, 340.0, 12.0)],
                               "initialsupply double, clearedsupply double, uigf double, semischedule_clearedmw double, "
                               "totalintermittentgeneration double")
    r = df.select(*[c.alias(n) for n, c in physical.derived_physical().items()]).first()
    assert (r.ramp, r.curtailment, r.intermittent_error) == (18.0, 0.0, -328.0)


def test_zero_demand_ratio_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "a double, b double")
    assert df.select(physical.ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_sensitivity_spread_skips_nulls(spark):
    cols = ", ".join(f"rrp{i} double" for i in range(1, 9))
    df = spark.createDataFrame([(150.0, None, 8000.0) + (None,) * 5, (None,) * 8], cols)
    assert [r[0] for r in df.select(physical.sensitivity_spread()).collect()] == [7850.0, None]


def test_exclude_administered_keeps_unknown_flags(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 0, 1), (4, None, None)], "id int, apcflag int, marketsuspendedflag int")
    assert [r.id for r in clean.exclude_administered(df).collect()] == [1, 4]


def test_vintage_spellings(spark):
    df = spark.createDataFrame([(None, 2026090901.0, "x"), ("NaT", None, "w"), ("r", 1.0, None), ("", None, "<NA>")],
                               "run_datetime string, predispatchseqno double, lastchanged string")
    assert [r.vintage for r in provenance.vintage(df).collect()] == ["2026090901", "w", "r", None]


def test_label_runs_leaves_unwritten_rows_unlabelled(spark):
    df = spark.createDataFrame([(ts("2024-01-01T00:00:00"), ts("2024-01-01T00:30:00")),
                                (ts("2024-01-01T00:00:00"), ts("2024-01-01T01:00:00")), (None, ts("2024-01-01T00:30:00"))],
                               "lastchanged timestamp_ntz, datetime timestamp_ntz")
    got = {(r.lastchanged, r.run_datetime) for r in clean.label_runs(df).collect()}
    assert got == {(ts("2024-01-01T00:00:00"), ts("2024-01-01T00:30:00")), (None, None)}


def test_chrono_split_labels_every_row(spark):
    df = days(spark, [("SA1", f"2024-01-{d:02d}", 0, 1.0) for d in range(1, 11)])
    got = [r.split for r in plan.chrono_split(df, "2024-01-04", "2024-01-08", 1).orderBy("trading_day").collect()]
    assert got == ["train"] * 3 + ["embargo"] + ["validation"] * 3 + ["embargo"] + ["test"] * 2


@pytest.fixture(scope="module")
def inputs(spark):
    from checks import base
    sf = "/root/testdata/sf0.001"
    return base.price_final(spark, sf), base.state_final(spark, sf), base.forecast(spark, sf)


LENIENT = Params(expected_intervals=1, exact_intervals=False, min_periods=1)


def test_late_knowledge_never_changes_features(spark, inputs):
    """The leakage property: rows published after the cutoff do not matter."""
    price, state, forecast = inputs
    after = timeaxis.cutoff_before(F.col("trading_day"), 20) + F.expr("INTERVAL '1' SECOND")
    late = forecast.withColumns({"known_at": after, "run_datetime": after, "rrp": F.lit(99999.0),
                                 "vintage": F.concat(F.lit("z"), F.col("vintage"))})
    before = plan.build_features(price, state, forecast, LENIENT)
    same_rows(before, plan.build_features(price, state, forecast.unionByName(late), LENIENT))


def test_later_cutoff_sees_at_least_as_much(spark, inputs):
    both = asof.snapshots(inputs[2], {"fc": 13, "ev": 20}, 0)
    assert both.where("ev_n_periods < fc_n_periods").count() == 0


def test_feature_columns(spark, inputs):
    assert len(plan.build_features(*inputs, LENIENT).columns) == 41


def test_trading_days_equals_filter_on_the_day(spark, inputs):
    price = inputs[0]
    by_day = price.where(F.col("trading_day").between("2024-01-05", "2024-01-07"))
    same_rows(timeaxis.trading_days(price, "settlementdate", "2024-01-05", "2024-01-07"), by_day)
