"""Table scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeaxis import ntz


def scan(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
         columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan reading only the columns asked for; columns a file lacks are null."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As `scan`, but a table with no folder or no files yet is empty instead of an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _place(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark keeps it; nothing happens if it is not there."""
    system, folder = _place(spark, path)
    system.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _place(spark, path)
    return system.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, none if it is not there."""
    system, folder = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def schema_drift(df: DataFrame, expected: T.StructType) -> dict[str, list[str]]:
    """Columns missing from, added to or retyped in a frame, from its schema alone."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    want = {f.name.lower(): f.dataType for f in expected}
    return {
        "missing": [c for c in want if c not in have],
        "extra": [c for c in have if c not in want],
        "retyped": [c for c in want if c in have and have[c] != want[c]],
    }


def json_rows(lines: DataFrame, schema: T.StructType, column: str = "value",
              key: Sequence[str] = ()) -> DataFrame:
    """Rows from JSON texts; unknown fields are ignored and unreadable dates become null.

    Time fields are taken as text first because a strict JSON read would lose the whole row
    to one bad date.
    """
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampNTZType, T.DateType))
                      else f.dataType) for f in schema])
    parsed = lines.select(*key, F.from_json(F.col(column), as_text).alias("_row")).select(*key, "_row.*")
    dated = {}
    for f in schema:
        if isinstance(f.dataType, T.TimestampNTZType):
            dated[f.name] = F.coalesce(F.col(f.name).try_cast("timestamp_ntz"),
                                       ntz(F.try_to_timestamp(F.col(f.name), F.lit("yyyy/MM/dd HH:mm:ss"))))
        elif isinstance(f.dataType, T.DateType):
            dated[f.name] = F.col(f.name).try_cast("date")
    return parsed.withColumns(dated) if dated else parsed


def reference_documents(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True) -> DataFrame:
    """Nested JSON documents read with a declared schema (objects as maps, lists as arrays)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def value_counts_by_file(df: DataFrame, column: str, file_column: str | None = None) -> DataFrame:
    """Counts of each value per file the rows came from."""
    name = (F.col(file_column) if file_column
            else F.substring_index(F.col("_metadata.file_path"), "/", -1))
    return (df.select(name.alias("file_name"), F.col(column)).groupBy("file_name", column)
            .agg(F.count(F.lit(1)).alias("n")))
