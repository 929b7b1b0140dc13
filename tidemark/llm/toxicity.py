"""Toxicity scores from a factorization machine over hashed terms.

A text is its set of hashed terms: lower-cased words of letters, and their first four and five
letters so that inflected forms meet.  The machine adds a weight per term and, for every pair of terms, the
product of their factors, so a pair can mean what neither term means alone.

The machine is fitted on a seeded sample of about ``MOST_ROWS`` labels at most, in three steps:
documents are counted per term and label; terms whose counts differ between labels beyond chance
become features; weights and factors are fitted on the driver, which fetches feature numbers only.
The sample of labels is small enough to be broadcast, so training moves no text.
Labels are used for training only; ids, languages and sources are never inputs of a score.

Defined cases: a null, empty or wordless text gets the score of a text without features; an id
with several labels counts as toxic if one of them is; null labels are ignored; without any
labelled row, or with labels of one kind only, scores are that kind's share (0.0 without rows);
repeated rows get equal scores; an empty table gives none.  Columns not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, buffer_of, cut, lean, range_hash, slices, word_bounds

BITS = 18
STEMS = (4, 5)
#: A term needs a log-likelihood ratio of twice the logarithm of the number of terms, which about
#: one of them reaches by chance, and to be in so many documents.
LEAST_ROWS = 3
MOST_TERMS = 4096
MOST_ROWS = 40_000
FACTORS = 4
STEPS = 300
RATE = 0.05
SPARSE = 0.2


def _letters() -> np.ndarray:
    """Bytes as lower-case letters; 0 for what ends a word.  Bytes beyond ASCII are letters."""
    table = np.zeros(256, np.uint8)
    table[128:] = np.arange(128, 256)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table


LOWER = _letters()


def terms(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct term, sorted."""
    low = LOWER[raw]
    start, end, row = word_bounds(low, offsets, np.arange(256) > 0)
    values = low.astype(np.uint64) + np.uint64(1)
    whole = range_hash(values, start, end)
    buckets, rows = [whole], [row]
    for size in STEMS:
        longer = end - start > size
        buckets.append(range_hash(values, start[longer], start[longer] + size) + np.uint64(0x5851F42D4C957F2D))
        rows.append(row[longer])
    buckets = np.concatenate(buckets) >> np.uint64(64 - bits)
    keys = np.unique(np.concatenate(rows).astype(np.uint64) << np.uint64(bits) | buckets)
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Machine:
    bias: float
    column_of: np.ndarray   # bucket -> feature, -1 for none
    weight: np.ndarray
    factor: np.ndarray      # feature x FACTORS

    def raw_scores(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        """Bias + weights + pairs; the pair sum is half of (square of sum - sum of squares)."""
        linear = np.bincount(row, weights=self.weight[feature], minlength=rows)
        pairs = np.zeros(rows)
        for f in range(self.factor.shape[1]):
            v = self.factor[feature, f]
            pairs += np.bincount(row, weights=v, minlength=rows) ** 2 - np.bincount(row, weights=v * v, minlength=rows)
        return self.bias + linear + pairs / 2

    def base_score(self) -> float:
        """The score of a text without features."""
        return float(1 / (1 + np.exp(-np.clip(np.array([self.bias]), -30, 30)))[0])

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros(len(offsets) - 1)
        for a, b in slices(offsets, 1 << 18):
            row, bucket = terms(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            feature = self.column_of[bucket]
            known = feature >= 0
            out[a:b] = self.raw_scores(row[known], feature[known], b - a)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(row: np.ndarray, feature: np.ndarray, label: np.ndarray, features: int, column_of: np.ndarray,
          factors: int = FACTORS, steps: int = STEPS, seed: int = 3) -> Machine:
    """Logistic loss with weight decay, whole-batch adaptive steps.

    Every step leaves out a fifth of the features of each row, at random but seeded, so that a term
    learns to speak for itself where texts usually hold several.
    """
    rows = len(label)
    share = label.mean() if rows else 0.0
    start = float(np.log((share + 1e-3) / (1 - share + 1e-3))) if rows else -30.0
    chance = np.random.default_rng(seed)
    machine = Machine(start, column_of, np.zeros(features), chance.normal(0, 0.05, (features, factors)))
    if not rows or not features or share in (0.0, 1.0):
        machine.factor[:] = 0
        machine.bias = start if 0 < share < 1 else (30.0 if share else -30.0)
        return machine
    params = {"bias": np.array([machine.bias]), "weight": machine.weight, "factor": machine.factor}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    whole_row, whole_feature = row, feature
    featured = np.bincount(row, minlength=rows) > 0
    for step in range(1, steps + 1):
        machine.bias = float(params["bias"][0])
        stays = chance.random(len(whole_row)) < 0.8
        row, feature = whole_row[stays], whole_feature[stays]
        gap = 1 / (1 + np.exp(-np.clip(machine.raw_scores(row, feature, rows), -30, 30))) - label
        gap[featured & (np.bincount(row, minlength=rows) == 0)] = 0  # nothing left to learn from
        on = gap[row]
        grads = {"bias": np.array([gap.sum()]), "weight": np.bincount(feature, weights=on, minlength=features),
                 "factor": np.empty_like(machine.factor)}
        for f in range(factors):
            v = machine.factor[feature, f]
            total = np.bincount(row, weights=v, minlength=rows)
            grads["factor"][:, f] = np.bincount(feature, weights=on * (total[row] - v), minlength=features)
        for k, p in params.items():
            g = grads[k] / rows + (0 if k == "bias" else 1e-5 * p)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            if k != "bias":  # small weights go to zero: terms that only accompany others stay silent
                p[:] = np.sign(p) * np.maximum(np.abs(p) - RATE * SPARSE, 0)
    machine.bias = float(params["bias"][0])
    return machine


def gain(toxic: np.ndarray, clean: np.ndarray, toxic_rows: int, clean_rows: int) -> np.ndarray:
    """Log-likelihood ratio of term presence against the label."""
    def part(x, total, rest, all_):
        with np.errstate(divide="ignore", invalid="ignore"):
            value = x * np.log(x * all_ / (total * rest))
        return np.where(x > 0, value, 0.0)

    all_ = toxic_rows + clean_rows
    have, lack = toxic + clean, all_ - toxic - clean
    return 2 * (part(toxic, toxic_rows, have, all_) + part(clean, clean_rows, have, all_)
                + part(toxic_rows - toxic, toxic_rows, lack, all_) + part(clean_rows - clean, clean_rows, lack, all_))


def labelled(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str, text_col: str,
             label_col: str, most_rows: int) -> DataFrame:
    """``text`` and ``toxic`` of the training rows whose label was drawn; one label per id."""
    marks = (labels.select(F.col(id_col).alias("marked_id"), (F.col(label_col).cast("int") != 0).cast("int").alias("mark"))
             .filter("marked_id is not null and mark is not null").groupBy("marked_id").agg(F.max("mark").alias("mark")))
    share = min(1.0, most_rows / max(1, marks.count()))
    drawn = cut(marks.filter(F.pmod(F.xxhash64(F.lit(17), "marked_id"), F.lit(1_000_000)) < share * 1_000_000))
    rows = bounded_batches(docs).filter(train_rows).select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text"))
    return (rows.join(F.broadcast(drawn), F.col("row_id") == F.col("marked_id"))  # about most_rows ids
            .select("text", F.col("mark").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most_rows: int = MOST_ROWS) -> Machine:
    rows = labelled(docs, labels, train_rows, id_col, text_col, label_col, most_rows)

    def count(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            sums = np.zeros((2, 1 << BITS), np.int64)
            for a, b in slices(at, 1 << 18):
                row, bucket = terms(raw[at[a]:at[b]], at[a:b + 1] - at[a])
                for kind in (0, 1):
                    sums[kind] += np.bincount(bucket[toxic[a + row] == kind], minlength=1 << BITS)
            have = np.flatnonzero(sums.any(axis=0))
            # Bucket -1 counts the rows themselves.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[have, -1]), pa.array(np.r_[sums[1, have], toxic.sum()]),
                 pa.array(np.r_[sums[0, have], (~toxic).sum()])], ["bucket", "toxic", "clean"])

    counted = (rows.mapInArrow(lean(count), "bucket long, toxic long, clean long")
               .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    # At most one row per bucket comes back.
    table = np.array([tuple(r) for r in counted.filter(F.col("toxic") + F.col("clean") >= LEAST_ROWS).collect()], np.int64).reshape(-1, 3)
    whole = table[table[:, 0] == -1]
    if not len(whole):
        whole = np.array([[-1, 0, 0]])
    toxic_rows, clean_rows = int(whole[0, 1]), int(whole[0, 2])
    table = table[table[:, 0] >= 0]
    gains = gain(table[:, 1].astype(float), table[:, 2].astype(float), toxic_rows, clean_rows)
    order = np.lexsort((table[:, 0], -gains))
    least = 2 * np.log(max(2, len(table)))
    chosen = [i for i in order[:MOST_TERMS] if gains[i] >= least]
    column_of = np.full(1 << BITS, -1, np.int64)
    column_of[np.sort(table[chosen, 0])] = np.arange(len(chosen))

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(column_of)

    def draw(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            out = []
            for a, b in slices(at, 1 << 18):
                row, bucket = terms(raw[at[a]:at[b]], at[a:b + 1] - at[a])
                feature = shared.value[bucket]
                keep = feature >= 0
                row, feature = row[keep], feature[keep]
                ends = np.searchsorted(row, np.arange(b - a + 1))
                out += [feature[ends[i]:ends[i + 1]] for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64())), pa.array(toxic)],
                                             ["features", "toxic"])

    drawn = rows.mapInArrow(lean(draw), "features array<long>, toxic long")
    # Rows of equal features come back once, with their counts.
    grouped = (drawn.groupBy(F.array_join(F.col("features").cast("array<string>"), " ").alias("f"))
               .agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("n")).collect())
    grouped = sorted((tuple(int(x) for x in r.f.split()), int(r.toxic), int(r.n)) for r in grouped)
    row, feature, label = [], [], []
    for f, t, n in grouped:
        for kind, times in ((1, t), (0, n - t)):
            for _ in range(times):
                row += [len(label)] * len(f)
                feature += f
                label.append(kind)
    return train(np.array(row, np.int64), np.array(feature, np.int64), np.array(label, float), len(chosen), column_of)


def score(docs: DataFrame, machine: Machine, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most MOST_TERMS features
    chosen = bounded_batches(docs).select(F.struct(*keep).alias("kept"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(raw, at))],
                                             ["kept", "score"])

    kept = chosen.schema["kept"].dataType.simpleString()
    return chosen.mapInArrow(lean(run), f"kept {kept}, score double").select("kept.*", "score")
