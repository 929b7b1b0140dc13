"""The corpus pipeline: the documents table through the text operators, stage by stage.

Every stage takes all rows its predecessor kept and gives back the same columns, whatever they are named;
the last one adds the size of each row and its source, the source's target and how many words the mix
takes of it.  Null texts are kept, empty tables stay empty, and repeated rows are rows of their own except
among near copies, where one row of each group stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, nearcopies, secretscan, simhash, toxicity
from tidemark.llm.common import cut, fold, stored

#: Documents at or above this score are rejected.
TOXIC = 0.3


def whole(docs: DataFrame) -> Column:
    """The row as a struct, so that no column of it meets one of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the limit; trained on labels outside fold 2.

    A text is rejected on evidence only: its score must also exceed that of an empty text.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.fit(docs, labels, fold(F.col("doc_id")) != 2)
    rows = docs.select(whole(docs), "text")
    kept = (F.col("score") < TOXIC) | (F.col("score") <= machine.base_score())
    return toxicity.score(rows, machine, [F.col("row")]).filter(kept).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: of fingerprints in tiles first, then of shingle sets alike.

    The second look is exact and finds copies whose fingerprints differ by more than the radius.
    """
    return nearcopies.one_of_each(simhash.one_of_each(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = cut(decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
                .select(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text")).distinct())
    rows = docs.select(whole(docs), "doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & F.col("text_hash").eqNullSafe(F.col("in_text"))
    return rows.join(decontaminate.small(found), same, "left_anti").select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked, with the length of the new text (null for a null text)."""
    scanner = secretscan.fit(docs, path=F.col("source"))
    masked = secretscan.redact(docs, scanner, F.col("source"))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it, by source weights."""
    return mixing.mix_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
]

#: The stages train models and follow links to any depth, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each stored and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
