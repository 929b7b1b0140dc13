"""Coverage, completeness and profile reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources.tables import union_all


def coverage_by_year(features: DataFrame, regions: int = len(fv.REGIONS)) -> DataFrame:
    return features.groupBy(F.year("trading_day").alias("year")).agg(
        F.count(F.lit(1)).alias("region_days"),
        F.count_distinct("trading_day").alias("days"),
        F.round(F.count(F.lit(1)) / regions, 0).alias("days_per_region"))


def spike_rate_by_region(features: DataFrame, digits: int = 3) -> DataFrame:
    return features.groupBy("regionid").agg(
        F.count(F.lit(1)).alias("days"), F.min("trading_day").alias("first_day"),
        F.max("trading_day").alias("last_day"), F.round(F.avg("spike"), digits).alias("spike_rate"))


def spike_rate_by_quarter(features: DataFrame, digits: int = 2,
                          regions: Sequence[str] = fv.REGIONS) -> DataFrame:
    """Quarter by region; the region list is given so the pivot needs no extra pass."""
    quarter = F.date_trunc("quarter", "trading_day").cast("date")
    rates = [F.round(F.avg(F.when(F.col("regionid") == r, F.col("spike"))), digits).alias(r.lower().rstrip("1"))
             for r in regions]
    return features.groupBy(quarter.alias("quarter")).agg(*rates)


def null_audit(features: DataFrame) -> DataFrame:
    checks = {"no_yesterday": "spike_yesterday", "no_7d": "spike_count_7d",
              "no_1300_forecast": "fc_max_rrp", "no_2000_forecast": "ev_max_rrp"}
    return features.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in checks.items()],
                        F.count(F.lit(1)).alias("total"))


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each condition per group; an unknown condition does not count."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def table_summary(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and first and last interval per table and source."""
    return union_all([
        df.groupBy(F.lit(name).alias("table_name"), "source").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("first_interval"),
            F.max(t).alias("last_interval"))
        for name, (df, t) in frames.items()])


def freshness(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest interval per table; null for an empty one."""
    return union_all([df.agg(F.max(t).alias("latest_interval"))
                      .select(F.lit(name).alias("table_name"), "latest_interval")
                      for name, (df, t) in frames.items()])


def load_sanity(price: DataFrame) -> DataFrame:
    return price.agg(
        F.min("settlementdate").alias("first_interval"), F.max("settlementdate").alias("last_interval"),
        F.round(F.min("rrp"), 2).alias("min_rrp"), F.round(F.max("rrp"), 2).alias("max_rrp"),
        F.count_distinct("regionid").alias("regions"))


def rows_by(df: DataFrame, *columns: str) -> DataFrame:
    """Row counts per value, most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *columns)


def storage_stats(df: DataFrame, name: str) -> DataFrame:
    """Rows, bytes and files of a stored table, from scan metadata."""
    per_file = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")) \
        .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b"))
    return per_file.agg(F.sum("n").alias("n_rows"), F.sum("b").alias("n_bytes"),
                        F.count(F.lit(1)).alias("parts")).select(F.lit(name).alias("table_name"), "*")


def thin_days(df: DataFrame, time_col: str, as_of: str, days: int, expected: float,
              share: float = fv.THIN_SHARE) -> DataFrame:
    """Recent whole days holding less than ``share`` of the expected rows.

    Days come from a calendar, so a day without any row is reported with zero.  The day of
    ``as_of`` is still filling and is left out.
    """
    today = F.lit(as_of).cast("date")
    start = F.date_sub(today, days)
    counts = (df.where((F.col(time_col) >= start.cast("timestamp_ntz"))
                       & (F.col(time_col) < today.cast("timestamp_ntz")))
              .groupBy(F.col(time_col).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows")))
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(start, F.date_sub(today, 1))).alias("day"))
    return (spine.join(counts, "day", "left")
            .select("day", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"))
            .where(F.col("n_rows") < expected * share))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(F.coalesce(F.sum("n"), zero).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")) \
        .withColumn("duplicates", F.col("n_rows") - F.col("n_keys"))


def join_alignment(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row counts of both sides and of their join, and rows without a partner.

    Each side is first counted per key, so repeated keys are multiplied as numbers instead of
    as rows.
    """
    lc = left.groupBy(*key).agg(F.count(F.lit(1)).alias("l"))
    rc = right.groupBy(*key).agg(F.count(F.lit(1)).alias("r"))
    both = lc.join(rc, list(key), "full_outer")
    zero = F.lit(0).cast("bigint")
    l, r = F.coalesce("l", zero), F.coalesce("r", zero)
    return both.agg(
        F.sum(l).alias("left_rows"), F.sum(r).alias("right_rows"), F.sum(l * r).alias("joined_rows"),
        F.sum(F.when(r == 0, l).otherwise(zero)).alias("left_only"),
        F.sum(F.when(l == 0, r).otherwise(zero)).alias("right_only"),
        F.count_if((l > 1) | (r > 1)).alias("repeated_keys"))


def _long(df: DataFrame, columns: Sequence[str], value_type: str) -> DataFrame:
    """(column_name, value) rows of the given columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(value_type).alias("value"))
                      for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*")


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, nulls, distinct values and row count of every column.

    Values are counted per (column, value) with a map-side combine, so a frequent value costs
    one row per task.  Distinct values of wide unique columns still have to be shuffled;
    ``exact=False`` estimates them in one pass without a shuffle.
    """
    if not exact:
        cells = [F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"),
                          F.count_if(F.col(c).isNull()).alias("n_null"),
                          F.approx_count_distinct(c).alias("n_distinct"), F.lit(t).alias("dtype"))
                 for c, t in df.dtypes]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    counted = _long(df, df.columns, "string").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    found = counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(zero)).alias("n_null"),
        F.count("value").alias("n_distinct"))
    # From the schema, so that an empty table still lists its columns.
    named = df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")
    return named.join(found, "column_name", "left").select(
        "column_name", *[F.coalesce(c, zero).alias(c) for c in ("n_rows", "n_null", "n_distinct")], "dtype")


def null_fraction(df: DataFrame, top: int | None = 15) -> DataFrame:
    """Share of nulls per column, highest first; one pass, one aggregate per column."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    out = _long(rates, df.columns, "double").withColumnRenamed("value", "null_fraction") \
        .orderBy(F.desc("null_fraction"), "column_name")
    return out.limit(top) if top else out


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    values = _long(df, columns, "double")
    basic = values.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(values, "value", [0.25, 0.5, 0.75], ["column_name"])
    return basic.join(quartiles.select(
        "column_name", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]),
        "column_name", "left")


def run_coverage(runs: DataFrame, run_hours: float) -> DataFrame:
    """How many days ahead the rows of runs at a given time of day reach."""
    return (runs.where(F.col("run_minute") == round(run_hours * 60))
            .groupBy(F.date_diff("target_day", "run_day").alias("days_ahead"))
            .agg(F.count(F.lit(1)).alias("n")))


def price_status_counts(price: DataFrame) -> DataFrame:
    """Rows per price status; anything but firm may still be revised."""
    return rows_by(price, "price_status")
