"""Multi-table report files: unpack archives, then split their lines into tables.

A report holds comment rows (``C``), column-name rows (``I``), data rows (``D``) and a footer
(``F``).  Fields two and three of ``I`` and ``D`` rows name the table, so a data row finds its
columns by joining on file and table instead of by reading files from top to bottom: text
files stay splittable and one huge file is many tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import provenance
from tidemark.operators import clean
from tidemark.sources import files
from tidemark.specs import SPECS, TableSpec

LINES = "path string, member string, name string, chunk bigint, line bigint, text string"
BATCH_LINES = 20_000


def read_text(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Lines of plain text reports.

    ``(chunk, line)`` is the order of lines in a file: the offset of the split a line was
    read from, then its place there.
    """
    return (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder)
            .select(F.col("_metadata.file_path").alias("path"), F.lit("").alias("member"),
                    F.col("_metadata.file_name").alias("name"),
                    F.col("_metadata.file_block_start").alias("chunk"),
                    F.monotonically_increasing_id().alias("line"),
                    F.col("value").alias("text")))


def _member_lines(archive: zipfile.ZipFile, outer: str | None) -> Iterator[tuple]:
    """(member, name carrying the time stamp, line number, text) of every CSV or text member."""
    for member in archive.namelist():
        lower = member.lower()
        if lower.endswith(".zip"):
            with archive.open(member) as inner, zipfile.ZipFile(io.BytesIO(inner.read())) as nested:
                for name, stamped, n, text in _member_lines(nested, member):
                    yield f"{member}/{name}", stamped, n, text
        elif lower.endswith((".csv", ".txt")):
            stamped = member if re.search(fv.PUBLISHED_STAMP, member) or \
                re.search(fv.INTERVAL_STAMP, member) else (outer or "")
            with archive.open(member) as raw:
                for n, line in enumerate(raw):
                    yield member, stamped, n, line.decode("utf-8", errors="replace").rstrip("\r\n")


#: Line number of the row that stands for an archive which could not be read to its end.
FAILED = -1


def _unpack_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "member", "name", "chunk", "line", "text"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = []
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member, stamped, n, text in _member_lines(archive, None):
                        rows.append((path, member, stamped, 0, n, text))
                        if len(rows) >= BATCH_LINES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
            except (zipfile.BadZipFile, zipfile.LargeZipFile, EOFError, NotImplementedError, RuntimeError, TypeError,
                    zlib.error) as e:
                rows.append((path, "", "", 0, FAILED, f"{type(e).__name__}: {e}"))
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def unpack(archives: DataFrame) -> DataFrame:
    """Lines of every text member of zip archives, nested ones included.

    The only Python on a data path: bytes have to be unzipped.  Archives spread over tasks and
    a member is streamed in batches of lines.  ``name`` is the innermost name that carries a
    time stamp; the archive's own name is not consulted.  An archive that is broken does not stop
    the others: its readable lines are kept and `failures` names it.
    """
    return archives.select("path", "content").mapInPandas(_unpack_batches, LINES)


def failures(lines: DataFrame) -> DataFrame:
    """``(path, error)`` of archives that could not be read to their end."""
    return lines.where(F.col("line") == FAILED).select("path", F.col("text").alias("error"))


def stored_lines(lines: DataFrame, folder: str) -> DataFrame:
    """Header, data and failure lines written to ``folder`` and read back.

    Archives are then unpacked once however many tables are taken from them.
    """
    kind = F.substring("text", 1, 2)
    lines.where(kind.isin("I,", "D,") | (F.col("line") == FAILED)).write.mode("overwrite").parquet(folder)
    return lines.sparkSession.read.schema(lines.schema).parquet(folder)


def read_archives(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Bytes of the archives below a folder, or of the files of a list and no others."""
    reader = spark.read.format("binaryFile")
    if isinstance(folder, str):
        reader = reader.option("pathGlobFilter", "*.[zZ][iI][pP]").option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", "content")


def fields(text: Column) -> Column:
    """Comma-separated fields of a line; quotes may hold commas and doubled quotes.

    Nearly all lines have no quote, and a split at commas gives theirs.
    """
    plain = ~text.contains('"') & ~text.startswith(",")
    raw = F.regexp_extract_all(text, F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    unquoted = F.transform(raw, lambda f: F.when(
        f.startswith('"'), F.replace(F.substring(f, 2, F.length(f) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(f))
    return F.when(plain, F.split(text, ",", -1)).otherwise(unquoted)


FILE_KEYS = ["path", "member"]
TABLE_KEYS = [*FILE_KEYS, "label"]


def _split_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header rows with their column lists, and data rows with their values."""
    kind = F.substring("text", 1, 2)
    # The label is told from the start of a line where that has no quote, so that filters on it split no line.
    start = F.substring_index("text", ",", 3)
    named = lambda f: F.upper(F.concat(F.trim(F.get(f, F.lit(1))), F.trim(F.get(f, F.lit(2)))))
    label = F.when(~start.contains('"'), named(F.split(start, ",", -1))).otherwise(named(fields(F.col("text"))))
    labelled = lines.where(kind.isin("I,", "D,") & (F.col("line") != FAILED)).select(
        *FILE_KEYS, "name", F.struct("chunk", "line").alias("at"), F.col("text").substr(1, 1).alias("kind"),
        label.alias("label"), fields(F.col("text")).alias("f"))
    rest = F.slice(F.col("f"), F.lit(5), F.greatest(F.size("f") - 4, F.lit(0)))
    heads = labelled.where(F.col("kind") == "I").select(
        *TABLE_KEYS, "at", F.transform(rest, lambda c: F.lower(F.trim(c))).alias("cols"))
    rows = labelled.where(F.col("kind") == "D").select(*TABLE_KEYS, "name", "at", rest.alias("vals"))
    return heads, rows


def repeated_headers(lines: DataFrame) -> DataFrame:
    """Tables announced more than once in a file, and whether their columns changed."""
    heads, _ = _split_rows(lines)
    return (heads.groupBy(*TABLE_KEYS)
            .agg(F.count(F.lit(1)).alias("headers"), F.count_distinct("cols").alias("layouts"))
            .where(F.col("headers") > 1))


def _with_columns_of_header(heads: DataFrame, rows: DataFrame, repeated: str) -> DataFrame:
    """Attach to every data row the columns of the last header before it.

    The headers of a table in one file (nearly always one) are an array in order of place, so one
    join serves files whose columns change as well, and rows need no order.
    """
    per_table = heads.groupBy(*TABLE_KEYS).agg(F.array_sort(F.collect_list(F.struct("at", "cols"))).alias("heads"))
    joined = rows.join(per_table, TABLE_KEYS)
    if repeated == "last":  # a later header replaces the earlier block
        joined = joined.withColumn("heads", F.slice("heads", -1, 1))
    before = F.filter("heads", lambda h: h["at"] < F.col("at"))
    return joined.withColumn("cols", F.try_element_at(before, F.lit(-1))["cols"]).where(F.col("cols").isNotNull()).drop("heads")


def parse_reports(lines: DataFrame, wanted: list[str] | None = None,
                  repeated: str = "union") -> dict[str, DataFrame]:
    """Lines to one typed DataFrame per warehouse table.

    ``wanted`` limits the tables.  A table announced twice in one file is a union of its
    blocks, or only the last block with ``repeated="last"``.  Each frame has the spec's
    columns plus ``published`` (from the innermost stamped name) and ``path``, ``member``.
    """
    heads, rows = _split_rows(lines)
    out = {}
    for table in wanted or list(SPECS):
        spec = SPECS[table]
        labels = [spec.name.upper(), *[k for k, v in fv.TABLE_ALIASES.items() if v == spec.name.upper()]]
        mine = F.col("label").isin(*labels)
        block = _with_columns_of_header(heads.where(mine), rows.where(mine), repeated)
        out[table] = _project(block, spec)
    return out


def _project(block: DataFrame, spec: TableSpec) -> DataFrame:
    # Places of the wanted columns are worked out once per row from its header list.
    cols = [F.get("vals", F.array_position("cols", c) - 1).alias(c) for c, _ in spec.columns]
    raw = block.select(*FILE_KEYS, provenance.publication_time(F.col("name")).alias("published"), *cols)
    typed = {c: clean.typed(F.nullif(F.col(c), F.lit("")), t) for c, t in spec.columns}
    return raw.withColumns(typed)


def ingest(lines: DataFrame, spec: TableSpec, source: Column | None = None,
           ingested_at: Column | None = None) -> DataFrame:
    """Report lines to provenance-stamped rows ready to merge."""
    parsed = parse_reports(lines, [spec.name])[spec.name]
    name = files.file_name(F.col("path"))
    known = provenance.known_at_report(F.col("published"), provenance.file_datetime(name))
    stamped = provenance.stamp(parsed, source if source is not None else provenance.file_tier(F.col("path")),
                               known, "file_timestamp", name, ingested_at)
    return provenance.vintage(clean.tidy(stamped, spec)) if spec.is_forecast else clean.tidy(stamped, spec)
