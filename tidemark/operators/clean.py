"""Typing, filters and source precedence: same grain in, same grain out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import physical, provenance, timeaxis
from tidemark.specs import TableSpec


def typed(c: Column, spark_type: str) -> Column:
    """Best-effort conversion from report text; what cannot be read becomes null."""
    if spark_type == "timestamp_ntz":
        text = c.cast("string")
        return F.coalesce(
            timeaxis.ntz(F.try_to_timestamp(text, F.lit(fv.REPORT_TIME_FORMAT))),
            text.try_cast("timestamp_ntz"))
    if spark_type in ("int", "bigint"):
        return c.cast("string").try_cast("double").try_cast(spark_type)
    return c.cast("string").try_cast(spark_type) if spark_type != "string" else c.cast("string")


def tidy(df: DataFrame, spec: TableSpec, regions: Sequence[str] = fv.REGIONS) -> DataFrame:
    """Allow-listed columns that are present, typed, for known regions only.

    Other columns (provenance) pass through behind them.
    """
    present = {c.lower(): c for c in df.columns}
    have = dict(df.dtypes)
    keep = []
    for name, spark_type in spec.columns:
        if name in present:
            c = F.col(present[name])
            keep.append((c if have[present[name]] == spark_type else typed(c, spark_type)).alias(name))
    extra = {c for c, _ in fv.PROVENANCE} | {"vintage"}
    keep += [F.col(c) for c in df.columns if c.lower() in extra]
    out = df.select(*keep)
    return out.where(F.col("regionid").isin(*regions)) if "regionid" in present else out


def pricing_run(df: DataFrame) -> DataFrame:
    return df.where(F.col("intervention") == 0)


def exclude_administered(df: DataFrame) -> DataFrame:
    """Drop intervals priced under an administered cap or a suspension; unknown flags stay."""
    flag = F.coalesce(F.col("apcflag"), F.lit(0)) + F.coalesce(F.col("marketsuspendedflag"), F.lit(0))
    return df.where(flag == 0)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], path: str = "aggregate") -> DataFrame:
    """One whole row per key, the smallest by ``order`` (nulls first).

    ``aggregate`` reduces on the map side, so a hot key costs one row per input task instead
    of travelling to a single window task.  ``window`` is the textbook form, kept to check it.
    """
    rest = [c for c in df.columns if c not in keys]
    if path == "window":
        w = Window.partitionBy(*keys).orderBy(*[o.asc() for o in order])
        return (df.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") == 1).drop("_pick"))
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                           for c in df.columns])


def finalise(df: DataFrame, time_col: str = "settlementdate", tiebreak: Sequence[str] = (),
             precedence: Sequence[str] = fv.SOURCE_PRECEDENCE,
             day_offset_minutes: int = fv.DAY_OFFSET_MINUTES, path: str = "aggregate") -> DataFrame:
    """The authoritative pricing-run row of every region and interval, with its trading day."""
    order = [provenance.source_rank(F.col("source"), precedence), *[F.col(c) for c in tiebreak]]
    best = first_by(pricing_run(df), ["regionid", time_col], order, path)
    return best.withColumn("trading_day", timeaxis.trading_day(F.col(time_col), day_offset_minutes))


def price_final(df: DataFrame, tiebreak: Sequence[str] = (), path: str = "aggregate", **kw) -> DataFrame:
    cols = ["regionid", "settlementdate", "intervention", "rrp", "price_status", "source", "known_at"]
    narrow = df.select(*dict.fromkeys([*cols, *tiebreak]))  # prune before rows become structs
    return finalise(narrow, tiebreak=tiebreak, path=path, **kw).select(
        "regionid", "settlementdate", "trading_day", "rrp", "price_status", "source", "known_at")


def regionsum_final(df: DataFrame, tiebreak: Sequence[str] = (), path: str = "aggregate", **kw) -> DataFrame:
    measures = ["totaldemand", "availablegeneration", "availableload", "netinterchange", "uigf",
                "semischedule_clearedmw"]
    cols = ["regionid", "settlementdate", "intervention", *measures, "source", "known_at"]
    narrow = df.select(*dict.fromkeys([*cols, *tiebreak]))
    out = finalise(narrow, tiebreak=tiebreak, path=path, **kw).withColumn(
        "margin", physical.margin(F.col("availablegeneration"), F.col("totaldemand")))
    return out.select("regionid", "settlementdate", "trading_day", *measures, "margin", "source", "known_at")


def forecast(price: DataFrame, state: DataFrame, day_offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> DataFrame:
    """Forecast price joined to forecast state of the same run and interval.

    Both sides keep only the pricing run, so an intervened interval cannot fan out.  The key
    has one row per run and interval, which spreads evenly over the shuffle.  Both sides have about as
    many rows, so neither is ever broadcast, whatever size the planner expects of one.
    """
    keys = ["regionid", "datetime", "vintage", "source"]
    left = pricing_run(price).select(*keys, "known_at", "run_datetime", "rrp")
    right = pricing_run(state).select(
        *keys, "totaldemand", "availablegeneration", "availableload", "uigf",
        F.col("ss_wind_uigf").alias("wind"), F.col("ss_solar_uigf").alias("solar"))
    return left.join(right.hint("merge"), keys).withColumns({
        "trading_day": timeaxis.trading_day(F.col("datetime"), day_offset_minutes),
        "margin": physical.margin(F.col("availablegeneration"), F.col("totaldemand")),
    })


def forecast_by_run_label(price: DataFrame, state: DataFrame,
                          day_offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> DataFrame:
    """The same join on the run label (monthly extracts carry no vintage)."""
    keys = ["run_datetime", "datetime", "regionid"]
    left = pricing_run(price).select(*keys, "rrp")
    right = pricing_run(state).select(
        *keys, "totaldemand", "availablegeneration", "availableload",
        F.col("ss_wind_uigf").alias("wind"), F.col("ss_solar_uigf").alias("solar"))
    return left.join(right, keys).withColumns({
        **timeaxis.run_calendar(F.col("run_datetime"), F.col("datetime"), day_offset_minutes),
        "margin": physical.margin(F.col("availablegeneration"), F.col("totaldemand")),
    })


def actuals(price: DataFrame, state: DataFrame) -> DataFrame:
    """Actual price beside actual state, one row per interval and region."""
    return price.join(state, ["settlementdate", "regionid"])


def label_runs(df: DataFrame, written: str = "lastchanged", target: str = "datetime") -> DataFrame:
    """Label every row with the first interval its write time covers.

    An aggregate joined back instead of a window: the aggregate combines on the map side and
    the join may split a hot write time, a window could not.
    """
    df = df.drop("run_datetime")
    known = df.where(F.col(written).isNotNull())
    labels = known.groupBy(written).agg(F.min(target).alias("run_datetime"))
    # Rows without a write time need no label and would all meet in one task of the join.
    rest = df.where(F.col(written).isNull()).withColumn("run_datetime", F.lit(None).cast(df.schema[target].dataType))
    return known.join(labels, written).unionByName(rest).withColumn("run_written_at", F.col(written))
