"""What was knowable at a cutoff: the newest run per interval, or one run per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import provenance, timeaxis

FORECAST_KEYS = ("regionid", "datetime", "trading_day")


def knowledge() -> Column:
    """Knowledge time a forecast row is filtered by."""
    return provenance.effective_known_at(F.col("known_at"), F.col("run_datetime"))


def recency(df: DataFrame) -> list[Column]:
    """Newest-last order of forecast rows: raw knowledge time (null loses), run, feed rank."""
    order = [F.col("known_at"), F.col("vintage")]
    if "source" in df.columns:
        order.append(-provenance.source_rank(F.col("source")))
    return order


def known_by(df: DataFrame, hours: float) -> DataFrame:
    """Rows knowable ``hours`` into the calendar day before their trading day."""
    return df.where(knowledge() <= timeaxis.cutoff_before(F.col("trading_day"), hours))


def asof_latest(df: DataFrame, keys: Sequence[str], known: Column, cutoffs: Mapping[str, Column],
                order: Sequence[Column], values: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Newest row per key for several cutoffs in one pass.

    Each cutoff yields a struct column named after it (null when nothing was known).  The
    aggregate combines on the map side, so neither the number of runs per key nor a hot key
    decides how much is shuffled, and the input is scanned once for all cutoffs.  ``carried``
    columns follow from the keys and stand behind them; they are neither sorted nor hashed by.
    """
    row = F.struct(*values)
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picks = [F.max_by(F.when(known <= cut, row), F.when(known <= cut, rank)).alias(name)
             for name, cut in cutoffs.items()]
    any_known = reduce(lambda a, b: a | b, [known <= cut for cut in cutoffs.values()])
    return df.where(any_known).groupBy(*keys).agg(*[F.max(c).alias(c) for c in carried], *picks)


def asof_latest_window(df: DataFrame, keys: Sequence[str], known: Column, cutoff: Column,
                       order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """One cutoff in the textbook form (rank, keep the first); the check of `asof_latest`."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    return (df.where(known <= cutoff).withColumn("_recency", F.row_number().over(w))
            .where(F.col("_recency") == 1).select(*keys, *values))


def forecast_asof(forecast: DataFrame, cutoff_hours: Mapping[str, float],
                  values: Sequence[str]) -> DataFrame:
    """`asof_latest` over joined forecasts; cutoffs are hours of the previous calendar day.

    The trading day follows from the interval, so rows are grouped by region and interval alone: in that order
    the join of the forecasts leaves them, and they are not sorted again.
    """
    cutoffs = {name: timeaxis.cutoff_before(F.col("trading_day"), h) for name, h in cutoff_hours.items()}
    *keys, day = FORECAST_KEYS
    return asof_latest(forecast, keys, knowledge(), cutoffs, recency(forecast), values, [day])


def unpack(selected: DataFrame, name: str, keys: Sequence[str] = FORECAST_KEYS) -> DataFrame:
    """Rows of one cutoff as plain columns."""
    return selected.where(F.col(name).isNotNull()).select(*keys, f"{name}.*")


def asof_run(df: DataFrame, cutoff_hours: float) -> DataFrame:
    """Rows of each day's last run at or before the cutoff that cover the next trading day.

    The run is chosen per run day across all regions.  ``df`` carries run_datetime and the
    `run_calendar` columns.
    """
    eligible = df.where(F.col("run_minute") <= round(cutoff_hours * 60))
    chosen = eligible.groupBy("run_day").agg(F.max("run_datetime").alias("run_datetime"))
    return (eligible.where(F.col("target_day") == F.date_add("run_day", 1))
            .join(chosen, ["run_day", "run_datetime"], "left_semi"))


SNAPSHOT_VALUES = ("rrp", "totaldemand", "margin", "wind", "solar", "availableload")


def snapshot_measures(prefix: str, of: str = "", threshold: float = fv.SPIKE_THRESHOLD) -> list[Column]:
    """The 14 daily measures of a snapshot.

    ``of`` names the struct column the values sit in.  The 0.9 quantile is exact: a group
    holds one row per interval of one day.
    """
    def v(name: str) -> Column:
        return F.col(f"{of}.{name}" if of else name)

    present = F.col(of).isNotNull() if of else F.lit(True)
    measures = {
        "max_rrp": F.max(v("rrp")),
        "mean_rrp": F.avg(v("rrp")),
        "p90_rrp": F.percentile(v("rrp"), F.lit(0.9)),
        "n_over_300": F.count_if(v("rrp") > threshold),
        "n_negative": F.count_if(v("rrp") < 0),
        "max_demand": F.max(v("totaldemand")),
        "mean_demand": F.avg(v("totaldemand")),
        "min_margin": F.min(v("margin")),
        "mean_margin": F.avg(v("margin")),
        "min_wind": F.min(v("wind")),
        "mean_wind": F.avg(v("wind")),
        "max_solar": F.max(v("solar")),
        "mean_load_bid": F.avg(v("availableload")),
        "n_periods": F.count_if(present),
    }
    return [c.alias(f"{prefix}_{name}") for name, c in measures.items()]


def snapshot_features(rows: DataFrame, prefix: str, min_periods: int = fv.MIN_FORECAST_PERIODS,
                      threshold: float = fv.SPIKE_THRESHOLD, day: str = "trading_day") -> DataFrame:
    """Selected forecast rows of one cutoff to one row per region and day."""
    daily = rows.groupBy("regionid", F.col(day).alias("trading_day")).agg(
        *snapshot_measures(prefix, threshold=threshold))
    return daily.where(F.col(f"{prefix}_n_periods") >= min_periods)


def snapshots(forecast: DataFrame, cutoff_hours: Mapping[str, float],
              min_periods: int = fv.MIN_FORECAST_PERIODS,
              threshold: float = fv.SPIKE_THRESHOLD) -> DataFrame:
    """Daily measures of every cutoff side by side, days complete at all of them.

    One scan, one shuffle to intervals and one to region-days serve all cutoffs, and the
    result needs no join between them.
    """
    picked = forecast_asof(forecast, cutoff_hours, SNAPSHOT_VALUES)
    measures = [m for name in cutoff_hours for m in snapshot_measures(name, name, threshold)]
    daily = picked.groupBy("regionid", "trading_day").agg(*measures)
    complete = reduce(lambda a, b: a & b,
                      [F.col(f"{name}_n_periods") >= min_periods for name in cutoff_hours])
    return daily.where(complete)


def snapshot(forecast: DataFrame, name: str, hours: float, min_periods: int = fv.MIN_FORECAST_PERIODS,
             threshold: float = fv.SPIKE_THRESHOLD) -> DataFrame:
    return snapshots(forecast, {name: hours}, min_periods, threshold)


def vintage_trace(forecast_price: DataFrame, price: DataFrame, region: str, interval: Column) -> DataFrame:
    """Every run's forecast of one interval beside what happened, in run order."""
    one = forecast_price.where((F.col("regionid") == region) & (F.col("datetime") == interval))
    actual = (price.where((F.col("regionid") == region) & (F.col("settlementdate") == interval))
              .select("regionid", F.col("settlementdate").alias("datetime"), F.col("rrp").alias("actual_rrp")))
    return (one.select("regionid", "datetime", "run_datetime", "vintage", "rrp")
            .join(actual, ["regionid", "datetime"], "left")
            .orderBy("run_datetime", "vintage"))
