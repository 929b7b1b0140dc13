"""Which files to read: selection by stamp, skipping what is stored, table names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import provenance
from tidemark.sources.tables import union_all


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path and name of every file below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(folder)
            .select("path", file_name(F.col("path")).alias("name")))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def select_files(files: DataFrame, start: Column, end: Column) -> DataFrame:
    """Files stamped within ``[start, end)``, oldest first, with their feed tier."""
    stamped = files.withColumns({
        "file_ts": provenance.file_datetime(F.col("name")),
        "tier": provenance.file_tier(F.col("path")),
    })
    return (stamped.where((F.col("file_ts") >= start) & (F.col("file_ts") < end))
            .orderBy("file_ts", "name"))


def stored_files(stored: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Distinct source files of a stored table, from the given years only if asked."""
    if years and "year" in stored.columns:
        stored = stored.where(F.col("year").isin(*years))
    return stored.where(F.col("source_file").isNotNull()).select("source_file").distinct()


def seen_manifest(stored: Mapping[str, DataFrame], years: list[int] | None = None) -> DataFrame:
    """(table_name, source_file) of everything stored, per table.

    Keyed by table because a file may be stored for one of its tables and still be missing
    for the other.
    """
    return union_all([stored_files(df, years).select(F.lit(name).alias("table_name"), "source_file")
                      for name, df in stored.items()])


def skip_seen(files: DataFrame, seen: DataFrame, name: str = "name") -> DataFrame:
    """Files not stored yet; per table when both sides say which table."""
    keys = [c for c in ("table_name",) if c in files.columns and c in seen.columns]
    known = seen.select(*keys, F.col("source_file").alias(name)).distinct()
    return files.join(known, [*keys, name], "left_anti")


def warehouse_table(label: Column) -> Column:
    """Warehouse name of a report label; labels without an alias keep their own."""
    upper = F.upper(label)
    named = upper
    for report, table in fv.TABLE_ALIASES.items():
        named = F.when(upper == report, table).otherwise(named)
    return named
