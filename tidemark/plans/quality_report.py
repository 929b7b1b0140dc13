"""The checks run after a feature build, as one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import evaluate, quality
from tidemark.sources.tables import union_all


def _long(df: DataFrame, check: str, subject: Column, skip: tuple[str, ...]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                      for c in df.columns if c not in skip])
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"),
                     F.explode(pairs).alias("p")).select("check", "subject", "p.*")


def quality_report(features: DataFrame) -> DataFrame:
    """(check, subject, measure, value) rows of every post-build check.

    The feature table is one row per region-day; materialise it first when it was expensive.
    """
    region = quality.spike_rate_by_region(features)
    quarter = quality.spike_rate_by_quarter(features)
    period = evaluate.evaluate_rule(features, by=[evaluate.benchmark_period(F.col("trading_day")).alias("period")])
    year = quality.coverage_by_year(features)
    nulls = quality.null_audit(features)
    return union_all([
        _long(region.drop("first_day", "last_day"), "spike_rate", F.col("regionid"), ("regionid",)),
        _long(quarter, "base_rate", F.col("quarter"), ("quarter",)),
        _long(period, "benchmark", F.col("period"), ("period",)),
        _long(year, "coverage", F.col("year"), ("year",)),
        _long(nulls, "nulls", F.lit("features"), ()),
    ])
