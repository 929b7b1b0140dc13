"""The leakage-safe feature tables and their chronological split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import physical, timeaxis
from tidemark.operators import asof, daily
from tidemark.specs import Params

KEYS = ["regionid", "trading_day"]

OUTCOME_COLUMNS = ["actual_max_rrp", "actual_mean_rrp", "actual_n_over_300"]
EV_MEASURES = ["max_rrp", "mean_rrp", "p90_rrp", "n_over_300", "n_negative", "max_demand",
               "mean_demand", "min_margin", "mean_margin", "min_wind", "mean_wind", "max_solar",
               "mean_load_bid"]
FC_MEASURES = ["max_rrp", "mean_rrp", "min_margin", "min_wind", "max_demand"]


def revisions(new: str = "ev", old: str = "fc",
              measures: tuple = ("max_rrp", "min_wind", "max_demand", "min_margin")) -> dict[str, Column]:
    """Movement of the forecast between two snapshots."""
    return {f"rev_{m}": F.col(f"{new}_{m}") - F.col(f"{old}_{m}") for m in measures}


def ratios(prefix: str = "ev") -> dict[str, Column]:
    """Scale-free versions of level features; null when demand is zero."""
    def c(m: str) -> Column:
        return F.col(f"{prefix}_{m}")

    return {
        f"{prefix}_margin_ratio": physical.ratio(c("min_margin"), c("max_demand")),
        f"{prefix}_wind_ratio": physical.ratio(c("mean_wind"), c("mean_demand")),
        f"{prefix}_load_bid_ratio": physical.ratio(c("mean_load_bid"), c("mean_demand")),
    }


def feature_columns() -> list[str]:
    """The 41 output columns in order."""
    return [*KEYS, "spike", *OUTCOME_COLUMNS,
            *[f"ev_{m}" for m in EV_MEASURES], *[f"fc_{m}" for m in FC_MEASURES],
            "rev_max_rrp", "rev_min_wind", "rev_max_demand", "rev_min_margin",
            "ev_margin_ratio", "ev_wind_ratio", "ev_load_bid_ratio",
            "spike_yesterday", "max_rrp_yesterday", "demand_yesterday", "margin_yesterday",
            "spike_count_7d", "max_rrp_7d", "dow", "month", "is_weekend", "season"]


def build_features(price: DataFrame, state: DataFrame, forecast: DataFrame,
                   params: Params = Params()) -> DataFrame:
    """One row per complete region-day: target, outcome and 35 features known at the cutoff.

    ``price`` and ``state`` are final actuals, ``forecast`` the joined vintages.  Forecast rows
    are reached only through the as-of selection, and same-day actuals only as outcome
    columns, so a row published after the cutoff cannot change a feature.
    """
    outcome = daily.daily_outcome(price, params.threshold, params.expected_intervals,
                                  params.exact_intervals)
    history = daily.with_history(outcome, params.rolling_rows)
    known = asof.snapshots(forecast, params.cutoff_hours, params.min_periods, params.threshold)
    rows = history.join(known, KEYS)
    rows = daily.join_yesterday(rows, daily.daily_state(state), {
        "actual_max_demand": "demand_yesterday", "actual_min_margin": "margin_yesterday"})
    rows = rows.withColumns({**revisions(), **ratios(),
                             **timeaxis.calendar_columns(F.col("trading_day"))})
    return rows.select(*feature_columns())


def assemble(outcome: DataFrame, decision: DataFrame, early: DataFrame) -> DataFrame:
    """Outcome beside both snapshots, for callers that hold them as separate frames."""
    return outcome.join(decision, KEYS).join(early, KEYS)


def build_features_by_run(price: DataFrame, forecast_runs: DataFrame, params: Params = Params(),
                          deadline_hours: float = 13, second_hours: float = 20) -> DataFrame:
    """The earlier daily build: one run per day instead of the newest row per interval.

    The deadline run (``fc``) must cover enough of the day; the second run (``am``) only feeds
    revisions and may be missing.
    """
    label = daily.daily_outcome(price, params.threshold, params.expected_intervals,
                                params.exact_intervals).select(
        *KEYS, "actual_max_rrp", "actual_mean_rrp", "actual_min_rrp", "spike")

    def day_of(prefix: str, hours: float, min_periods: int) -> DataFrame:
        rows = asof.asof_run(forecast_runs, hours)
        return asof.snapshot_features(rows, prefix, min_periods, params.threshold, day="target_day")

    fc = day_of("fc", deadline_hours, params.min_periods).drop("fc_n_periods")
    am = day_of("am", second_hours, 0).select(*KEYS, "am_max_rrp", "am_min_wind", "am_max_demand")
    day = F.col("trading_day")
    return label.join(fc, KEYS).join(am, KEYS, "left").withColumns({
        **revisions("fc", "am", ("max_rrp", "min_wind", "max_demand")),
        "dow": F.weekday(day),  # this build counts Monday as 0
        "month": F.month(day), "is_weekend": (F.weekday(day) >= 5).cast("int"),
        "season": timeaxis.season(F.month(day)),
    })


def chrono_split(features: DataFrame, train_end: str, valid_end: str, embargo_days: int) -> DataFrame:
    """Label rows train, embargo, validation or test by day; nothing is dropped.

    An embargo of ``embargo_days`` follows the training and the validation period.
    """
    day = F.col("trading_day")
    first, second = F.lit(train_end).cast("date"), F.lit(valid_end).cast("date")
    return features.withColumn(
        "split",
        F.when(day < first, "train")
        .when(day < F.date_add(first, embargo_days), "embargo")
        .when(day < second, "validation")
        .when(day < F.date_add(second, embargo_days), "embargo")
        .otherwise("test"))
