"""Language identification with a blended-spectrum string kernel.

A text is cut into pieces of ``PIECE`` characters (all of them count).  A piece is the set of the
n-grams of 1 to 4 characters it holds; the kernel of two pieces is the number of n-grams they
share over the geometric mean of their set sizes.  Landmarks give a Nystroem feature map, and one
ridge regression per language against the rest is fitted on it.  Scoring is two matrix products
per batch of pieces; a document's scores are the mean over its pieces, weighted by length.

The model is fitted on the driver on at most ``PER_LANGUAGE`` pieces of each language, one from a
seeded place in each sampled text; ids, sources and labels are never inputs of a prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without any
labelled row every text is ``und``; repeated rows get equal predictions; an empty table gives
none.  Columns other than those named are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches

PIECE = 2000
ORDERS = 4
BITS = 20
PER_LANGUAGE = 400
LANDMARKS = 128
COLUMNS = 4096
MAX_LANGUAGES = 1000
RIDGE = 1e-2
SHARPNESS = 6.0
GAP = " " * ORDERS

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of every code point below 0x30000, a space for what is no letter."""
    if not _TABLES:
        lower = np.full(0x30000, 32, np.uint32)
        for c in range(0x30000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _TABLES["lower"] = lower
    return _TABLES["lower"], _TABLES["lower"] != 32


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letter flags of the characters, and the bucket of the n-gram at each place for every order."""
    lower, _ = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < 0x30000, lower[np.minimum(codes, 0x2FFFF)], codes).astype(np.uint64)
    out = np.zeros((ORDERS, len(codes)), np.int64)
    state = np.zeros(len(codes), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(codes) < n:
            break
        size = len(codes) - n + 1
        state = state[:size] * np.uint64(0x100000001B3) + codes[n - 1:]
        mixed = (state + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out[n - 1, :size] = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)
        out[n - 1, size:] = out[n - 1, size - 1]
    return codes != 32, out


@dataclass
class Model:
    languages: list[str]
    column_of: np.ndarray      # bucket -> column, the last column for n-grams outside the vocabulary
    landmarks: np.ndarray      # unit rows over the columns
    weights: np.ndarray        # landmark -> language


def presence(text: str, piece_of: np.ndarray, pieces: int, column_of: np.ndarray, columns: int) -> tuple:
    """Presence of the vocabulary in each piece of a text of many pieces, and letters per piece."""
    letters, buckets = grams(text)
    seen = np.zeros((pieces, columns + 1), np.float32)
    flat = seen.reshape(-1)
    base = piece_of * (columns + 1)
    for row in buckets:
        flat[base + column_of[row]] = 1
    return seen[:, :columns], np.bincount(piece_of, weights=letters, minlength=pieces)


def _unit(seen: np.ndarray) -> np.ndarray:
    return seen / np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))


def fit(pieces: list[tuple[str, str]], landmarks: int = LANDMARKS, columns: int = COLUMNS) -> Model | None:
    """A model of ``(text, language)`` pieces; their order does not matter."""
    pieces = sorted(p for p in set(pieces) if re.search(r"[^\W\d_]", p[0]))
    if not pieces:
        return None
    languages = sorted({lang for _, lang in pieces})
    share = {lang: 1 / sum(1 for _, other in pieces if other == lang) for lang in languages}
    often = np.zeros((len(languages), 1 << BITS), np.float32)
    for text, lang in pieces:
        _, buckets = grams(text + GAP)
        often[languages.index(lang), np.unique(buckets)] += share[lang]
    # The n-grams whose presence differs most between pieces, languages counting alike.
    mean = often.mean(axis=0)
    spread = mean * (1 - mean) + often.var(axis=0)
    chosen = np.argsort(-spread, kind="stable")[:columns]
    chosen = np.sort(chosen[spread[chosen] > 0])
    if not len(chosen):
        chosen = np.flatnonzero(mean)[:columns]
    column_of = np.full(1 << BITS, len(chosen), np.int64)
    column_of[chosen] = np.arange(len(chosen))
    rows = np.concatenate([presence(t + GAP, np.zeros(len(t) + len(GAP), np.int64), 1, column_of, len(chosen))[0]
                           for t, _ in pieces])
    rows = _unit(rows)
    target = np.array([[1.0 if lang == other else -1.0 for other in languages] for _, lang in pieces])
    weight = np.array([share[lang] for _, lang in pieces])[:, None]
    places = np.random.default_rng(7).permutation(len(pieces))
    per = max(1, landmarks // len(languages))
    picked = [i for lang in languages for i in [p for p in places if pieces[p][1] == lang][:per]]
    marks = rows[picked]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    mapped = (rows @ marks.T).astype(float) @ whiten
    left = mapped.T @ (mapped * weight) + RIDGE * np.eye(mapped.shape[1])
    solved = np.linalg.solve(left, mapped.T @ (target * weight))
    return Model(languages, column_of, marks.astype(np.float32), (whiten @ solved).astype(np.float32))


def decide(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of every text."""
    out_lang, out_score = ["und"] * len(texts), [0.0] * len(texts)
    if model is None:
        return out_lang, out_score
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") < 1 << 18):
            size += len(texts[end] or "")
            end += 1
        joined, piece_of, owner = [], [], []
        for k in range(at, end):
            text = texts[k] or ""
            # Long texts are cut in pieces of equal length; each keeps its share of the letters.
            count = max(1, -(-len(text) // PIECE))
            piece_of.append(len(owner) + np.arange(len(text) + len(GAP)) * count // (len(text) + len(GAP)))
            owner += [k] * count
            joined.append(text + GAP)
        _score(model, "".join(joined), np.concatenate(piece_of), np.array(owner), out_lang, out_score)
        at = end
    return out_lang, out_score


def _score(model: Model, text: str, piece_of: np.ndarray, owner: np.ndarray, langs: list, scores: list) -> None:
    columns = model.landmarks.shape[1]
    first = int(owner[0])
    total = np.zeros((int(owner[-1]) - first + 1, len(model.languages)))
    letters = np.zeros(len(total))
    step = 256
    for s in range(0, len(owner), step):
        e = min(s + step, len(owner))
        lo, hi = np.searchsorted(piece_of, [s, e])
        seen, have = presence(text[lo:hi], piece_of[lo:hi] - s, e - s, model.column_of, columns)
        score = (_unit(seen) @ model.landmarks.T) @ model.weights
        np.add.at(total, owner[s:e] - first, score * have[:, None])
        np.add.at(letters, owner[s:e] - first, have)
    mean = total / np.maximum(letters, 1)[:, None]
    chance = np.exp(SHARPNESS * (mean - mean.max(axis=1, keepdims=True)))
    chance /= chance.sum(axis=1, keepdims=True)
    for i, best in enumerate(mean.argmax(axis=1)):
        if letters[i]:
            langs[first + i], scores[first + i] = model.languages[best], float(chance[i, best])


def training_pieces(docs: DataFrame, train: Column, lang_col: str, text_col: str, per_language: int) -> list:
    """At most ``per_language`` pieces of each language, from seeded texts and places.

    Of more than ``MAX_LANGUAGES`` languages those with the most distinct texts are learned.
    """
    rows = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # Draws are by distinct text, so shares are of distinct texts: copies take no place from others.
    kinds = rows.select(F.col(lang_col).alias("of_lang"), F.xxhash64(F.lit(11), F.col(text_col)).alias("draw")).distinct()
    # Twice the wanted share by hash, then the least hashes; the table has at most MAX_LANGUAGES rows.
    share = kinds.groupBy("of_lang").count().orderBy(F.desc("count"), "of_lang").limit(MAX_LANGUAGES).select(
        "of_lang", F.least(F.lit(1.0), 2.0 * per_language / F.col("count") + 1e-4).alias("share"))
    drawn = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                        F.xxhash64(F.lit(11), F.col(text_col)).alias("draw"))
    drawn = drawn.join(F.broadcast(share), F.col("lang") == F.col("of_lang"))
    drawn = drawn.filter(F.pmod("draw", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    place = F.pmod(F.xxhash64(F.lit(13), "draw"), F.greatest(F.char_length("text") - PIECE, F.lit(0)) + 1) + 1
    drawn = drawn.select("lang", "draw", F.substring("text", place.cast("int"), F.lit(PIECE)).alias("piece"))
    drawn = drawn.dropDuplicates(["lang", "draw"])
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    return [(r.piece, r.lang) for r in ranked.filter(F.col("rank") <= per_language).collect()]


def identify(docs: DataFrame, train: Column, keep: list[Column], text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row."""
    model = fit(training_pieces(docs, train, lang_col, text_col, per_language))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LANDMARKS x COLUMNS numbers
    chosen = bounded_batches(docs).select(F.struct(*keep).alias("kept"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            langs, scores = decide(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["kept", "lang_pred", "score"])

    kept = chosen.schema["kept"].dataType.simpleString()
    return (chosen.mapInArrow(run, f"kept {kept}, lang_pred string, score double")
            .select("kept.*", "lang_pred", "score"))
