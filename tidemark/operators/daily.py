"""Interval to region-day, and looking back over region-days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def outcome_measures(threshold: float = fv.SPIKE_THRESHOLD):
    return [
        F.max("rrp").alias("actual_max_rrp"),
        F.avg("rrp").alias("actual_mean_rrp"),
        F.min("rrp").alias("actual_min_rrp"),
        F.count_if(F.col("rrp") > threshold).alias("actual_n_over_300"),
        F.count_if(F.col("rrp") < 0).alias("actual_n_negative"),
        (F.max("rrp") > threshold).cast("int").alias("spike"),
        F.count(F.lit(1)).alias("n_intervals"),
    ]


def daily_outcome(price: DataFrame, threshold: float = fv.SPIKE_THRESHOLD,
                  expected: int = fv.INTERVALS_PER_DAY, exact: bool = True) -> DataFrame:
    """The label and outcome of every complete region-day.

    ``exact`` asks for precisely ``expected`` intervals; otherwise for at least that many.
    """
    daily = price.groupBy("regionid", "trading_day").agg(*outcome_measures(threshold))
    n = F.col("n_intervals")
    return daily.where(n == expected if exact else n >= expected)


def daily_state(state: DataFrame) -> DataFrame:
    return state.groupBy("regionid", "trading_day").agg(
        F.max("totaldemand").alias("actual_max_demand"),
        F.avg("totaldemand").alias("actual_mean_demand"),
        F.min("margin").alias("actual_min_margin"),
        F.avg("availableload").alias("actual_mean_load_bid"),
    )


def _by_region():
    return Window.partitionBy("regionid").orderBy("trading_day")


def persistence(daily: DataFrame, rows: int = fv.ROLLING_ROWS) -> DataFrame:
    """Spikes and highest price over the previous complete days; today is excluded.

    Windows by region are safe here and only here: the input has one row per region-day.
    """
    past = _by_region().rowsBetween(-rows, -1)
    return daily.select(
        "regionid", "trading_day",
        F.sum("spike").over(past).alias("spike_count_7d"),
        F.max("actual_max_rrp").over(past).alias("max_rrp_7d"))


def join_yesterday(daily: DataFrame, other: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Left join of the previous CALENDAR day (a gap gives null, unlike a previous row)."""
    prior = other.select("regionid", F.date_add("trading_day", 1).alias("trading_day"),
                         *[F.col(src).alias(dst) for src, dst in columns.items()])
    return daily.join(prior, ["regionid", "trading_day"], "left")


def with_history(daily: DataFrame, rows: int = fv.ROLLING_ROWS) -> DataFrame:
    """`persistence` and the outcome part of `join_yesterday` in one window pass.

    Region-days are unique, so the previous calendar day, if there is one, is the previous
    row; checking its date makes ``lag`` equal to the calendar join without a self join.
    """
    w = _by_region()
    past = w.rowsBetween(-rows, -1)
    adjacent = F.lag("trading_day").over(w) == F.date_sub("trading_day", 1)
    return daily.withColumns({
        "spike_yesterday": F.when(adjacent, F.lag("spike").over(w)),
        "max_rrp_yesterday": F.when(adjacent, F.lag("actual_max_rrp").over(w)),
        "spike_count_7d": F.sum("spike").over(past),
        "max_rrp_7d": F.max("actual_max_rrp").over(past),
    })


def spike_autocorrelation(daily: DataFrame) -> DataFrame:
    """Lag-1 correlation of the spike flag per region, over consecutive calendar days."""
    pairs = join_yesterday(daily.select("regionid", "trading_day", "spike"), daily,
                           {"spike": "prior"}).where(F.col("prior").isNotNull())
    return pairs.groupBy("regionid").agg(
        F.corr(F.col("spike").cast("double"), F.col("prior").cast("double")).alias("lag1_corr"),
        F.count(F.lit(1)).alias("pairs"))
