"""Distributions and comparisons used while studying the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import fixed_values as fv
from tidemark.functions import timeaxis
from tidemark.operators.quantiles import exact_quantiles


def price_day_stats(price: DataFrame, day: str, threshold: float = fv.SPIKE_THRESHOLD,
                    day_offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> DataFrame:
    """Per-region summary of one trading day of final prices."""
    one = timeaxis.trading_days(price, "settlementdate", day, day, day_offset_minutes)
    return one.groupBy("regionid").agg(
        F.min("rrp").alias("min"), F.avg("rrp").alias("mean"), F.median("rrp").alias("median"),
        F.max("rrp").alias("max"), F.count_if(F.col("rrp") > threshold).alias("n_over"),
        F.count_if(F.col("rrp") < 0).alias("n_negative"), F.count(F.lit(1)).alias("n_intervals"))


def day_range(price: DataFrame, day_offset_minutes: int = fv.DAY_OFFSET_MINUTES) -> DataFrame:
    """First and last available trading day with the labels that bound them."""
    day = timeaxis.trading_day(F.col("settlementdate"), day_offset_minutes)
    out = price.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return out.withColumns({
        "first_label": timeaxis.day_start(F.col("first_day"), day_offset_minutes),
        "last_label": timeaxis.day_end(F.col("last_day"), day_offset_minutes)})


def negative_share(price: DataFrame) -> DataFrame:
    return price.groupBy("regionid").agg(
        F.avg((F.col("rrp") < 0).cast("int")).alias("negative_share"), F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, keys: Sequence[str], lo: float = fv.HISTOGRAM_RANGE[0],
              hi: float = fv.HISTOGRAM_RANGE[1], bins: int = fv.HISTOGRAM_BINS) -> DataFrame:
    """Counts per equal-width bin in ``[lo, hi]``; the top edge belongs to the last bin."""
    inside = df.where(F.col(column).between(lo, hi))
    number = F.least(F.width_bucket(F.col(column), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return inside.groupBy(*keys, number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def median_by_hour_season(price: DataFrame, day_column: str = "settlementdate") -> DataFrame:
    """Median final price by season and hour, and the number of prices.

    A group grows with history, so its values are never gathered in one task.
    """
    t = F.col(day_column)
    keys = ["regionid", "season", "hour"]
    rows = price.select("regionid", timeaxis.season(F.month(t)).alias("season"), F.hour(t).alias("hour"), "rrp")
    return exact_quantiles(rows, "rrp", [0.5], keys).select(*keys, F.col("q")[0].alias("median_rrp"), "n")


def quantile_bins(df: DataFrame, by: str, value: str, bins: int = 10) -> DataFrame:
    """Median and mean of ``value`` within quantile bins of ``by``.

    Bins close on the right, the lowest value joins the first bin and repeated edges merge,
    so equal values never split across bins.
    """
    # At most bins + 1 numbers come to the driver and go back as literals.
    found = exact_quantiles(df, by, [i / bins for i in range(bins + 1)]).select("q").first()
    edges = sorted(set(found.q)) if found else []
    rows = df.where(F.col(by).isNotNull() & ~F.isnan(F.col(by).cast("double")))
    below = sum([F.when(F.lit(e) < F.col(by), 1).otherwise(0) for e in edges], F.lit(0))
    number = F.greatest(below, F.lit(1))
    # Counted per bin and value once; mean and median both start from there.
    counted = rows.select(number.alias("bin"), F.col(value).cast("double").alias("_v"), F.col(by).alias("_by")) \
        .groupBy("bin", "_v").agg(F.count(F.lit(1)).alias("_c"), F.min("_by").alias("_lo"), F.max("_by").alias("_hi"))
    known = F.when(F.col("_v").isNotNull(), F.col("_c"))
    mean = counted.groupBy("bin").agg(
        (F.sum(F.col("_v") * F.col("_c")) / F.sum(known)).alias("mean"), F.min("_lo").alias("lowest"),
        F.max("_hi").alias("highest"), F.sum("_c").alias("n"))
    median = exact_quantiles(counted, "_v", [0.5], ["bin"], "_c").select("bin", F.col("q")[0].alias("median"))
    return mean.join(median, "bin", "left")


def exceedance(df: DataFrame, keys: Sequence[str], column: str = "rrp",
               thresholds: Sequence[float] = fv.EXCEEDANCE_THRESHOLDS) -> DataFrame:
    """Rows above each threshold per group: one aggregate pass, thresholds unfolded after."""
    hits = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.col(column) > t).alias("n_over"))
            for t in thresholds]
    counted = df.groupBy(*keys).agg(F.array(*hits).alias("hits"), F.count(column).alias("n"))
    flat = counted.select(*keys, "n", F.explode("hits").alias("h")).select(*keys, "n", "h.*")
    return flat.withColumn("pct", 100 * F.col("n_over") / F.col("n"))


def daily_spike_rate(price: DataFrame, threshold: float = fv.SPIKE_THRESHOLD) -> DataFrame:
    """Share of calendar days whose highest price exceeds the threshold, per region."""
    days = price.groupBy("regionid", F.col("settlementdate").cast("date").alias("day")).agg(
        F.max("rrp").alias("max_rrp"))
    return days.groupBy("regionid").agg(
        F.avg((F.col("max_rrp") > threshold).cast("int")).alias("spike_rate"), F.count(F.lit(1)).alias("days"))


def median_abs_error(df: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Median absolute difference of each named pair, over the whole table."""
    errors = F.array(*[F.struct(F.lit(name).alias("measure"), F.abs(a - b).alias("error"))
                       for name, (a, b) in pairs.items()])
    long = df.select(F.explode(errors).alias("e")).select("e.*")
    return exact_quantiles(long, "error", [0.5], ["measure"]).select(
        "measure", "n", F.col("q")[0].alias("median_abs_error"))


def tumble(df: DataFrame, time_col: str, keys: Sequence[str], measures: Sequence[Column],
           width: str = "30 minutes") -> DataFrame:
    """Aggregate end-labelled intervals into wider end-labelled ones."""
    bucket = timeaxis.interval_end_bucket(F.col(time_col), width)
    return df.groupBy(*keys, bucket.alias("bucket_end")).agg(*measures)


def downsample_compare(forecast: DataFrame, price: DataFrame, width: str = "30 minutes") -> DataFrame:
    """Forecast of each wide interval beside the mean of the actual intervals inside it."""
    actual = tumble(price, "settlementdate", ["regionid"],
                    [F.avg("rrp").alias("actual_rrp"), F.count(F.lit(1)).alias("n_intervals")], width)
    return forecast.join(actual.withColumnRenamed("bucket_end", "datetime"), ["regionid", "datetime"])


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """A repeatable sample of n rows: the smallest hashes of key and seed.

    Rows are counted by the first hex digits of their hash; whole groups below the one in which the
    n-th row lies are taken as they are, and only that group is ranked.
    """
    marked = df.withColumn("_hash", F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))))
    marked = marked.withColumn("_group", F.substring("_hash", 1, 4))
    sizes = marked.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))  # 65,536 rows at most
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < n)
    near = marked.join(F.broadcast(sizes), "_group")
    whole = near.where(F.col("_before") + F.col("_n") <= n)
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", *key))
    part = near.where(F.col("_before") + F.col("_n") > n).withColumn("_rank", rank).where(F.col("_before") + F.col("_rank") <= n)
    return whole.select(*df.columns).unionByName(part.select(*df.columns))
