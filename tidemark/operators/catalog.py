"""The data dictionary as a table: documentation that can be joined to schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.dictionary import ROWS

SCHEMA = "table_name string, column_name string, timing string, unit string, description string"


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ROWS), SCHEMA)


def schema_frame(df: DataFrame, table_name: str) -> DataFrame:
    """Columns of a frame as rows: table, column, position and type."""
    rows = [(table_name, c.lower(), i, t) for i, (c, t) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, position int, dtype string")


def describe_columns(columns: DataFrame, words: DataFrame) -> DataFrame:
    """Columns with their own table's entry, else the shared ``*`` entry, else nulls.

    Two equi-joins instead of one join with OR in its condition.
    """
    info = ["timing", "unit", "description"]
    own = words.where(F.col("table_name") != "*").select(
        "table_name", "column_name", F.struct(*info).alias("_own"))
    shared = words.where(F.col("table_name") == "*").select("column_name", F.struct(*info).alias("_shared"))
    out = columns.join(own, ["table_name", "column_name"], "left").join(shared, "column_name", "left")
    best = F.coalesce("_own", "_shared")
    return out.select(*columns.columns, *[best.getField(i).alias(i) for i in info])


def undocumented(columns: DataFrame, words: DataFrame) -> DataFrame:
    """Columns neither their table's nor the shared entries cover."""
    shared = words.where(F.col("table_name") == "*").select("column_name")
    return (columns.join(words.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti")
            .join(shared, "column_name", "left_anti"))


def timing_rank(timing: Column) -> Column:
    rank = None
    for i, name in enumerate(fv.TIMING_ORDER, start=1):
        rank = F.when(timing == name, i) if rank is None else rank.when(timing == name, i)
    return rank.otherwise(len(fv.TIMING_ORDER) + 1)


def sorted_entries(entries: DataFrame) -> DataFrame:
    """Keys, target, outcomes, features; by name within each."""
    return entries.orderBy(timing_rank(F.col("timing")), "column_name")


def numbered_entries(entries: DataFrame) -> DataFrame:
    """`sorted_entries` with the place as a column; there is one row per column of a table."""
    w = Window.partitionBy("table_name").orderBy(timing_rank(F.col("timing")), "column_name")
    return entries.withColumn("place", F.row_number().over(w))


def safe_columns(df: DataFrame, words: DataFrame, table_name: str,
                 timings: Sequence[str] = fv.SAFE_TIMINGS) -> DataFrame:
    """Only the columns whose timing allows training on them.

    The dictionary holds one row per column, so reading the allowed names is small.
    """
    allowed = {r.column_name for r in words.where(
        (F.col("table_name") == table_name) & F.col("timing").isin(*timings)).select("column_name").collect()}
    return df.select(*[c for c in df.columns if c.lower() in allowed])
