"""Secret scanning: wide candidate patterns, and a random forest that removes false positives.

Candidates are long tokens with digits (or in capitals) and values assigned to names such as
``password`` or ``token``.  The forest sees the length of a candidate, its character mix, the
likelihood of its character transitions in the corpus, how much of it dictionary words cover, its
path (the file or source it is in, and path marks around it) and the words next to it.

Transitions and dictionary are counted over all documents; the dictionary is a table of 2**18
word-hash counters, so its size is fixed.  Labelled findings train the forest on the driver, at
most ``MOST_FINDINGS`` of each label, drawn by hash.

Where no labelled findings are given, they are made by ``weak_label``: strict published formats and
assigned random values count as secrets, mail hosts, addresses, versions and words as false
positives, and everything else stays unlabelled.

Defined cases: null and empty texts hold no candidate; without labelled findings of both kinds the
forest predicts the share of secrets among them (0 without any); repeated rows give their findings
each; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import forest
from tidemark.llm.common import bounded_batches, buffer_of, cut, lean, range_hash, slices, word_bounds

MOST_FINDINGS = 5000
BITS = 18
THRESHOLD = 0.5
MASK = "[SECRET]"
TOKEN = re.compile(r"[A-Za-z0-9+/_.~\-]{12,}={0,2}")
ASSIGNED = re.compile(r"(?i)\b[a-z_]*(?:password|passwd|pwd|secret|token|api_?key|access_?key|credential)s?"
                      r"\s*[:=]\s*[\"']?([^\s\"',;]{6,})")
KEY_NAMES = ("password", "passwd", "pwd", "secret", "token", "apikey", "key", "credential")
#: Published formats: cloud access keys, source-host tokens, chat tokens, signed web tokens.
STRICT = re.compile(r"(?:AKIA|ASIA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
FEATURES = ("length", "digits", "capitals", "lowers", "marks", "distinct", "entropy", "switches", "transitions",
            "rarest", "dictionary", "hex", "assigned", "quoted", "dots", "in_path", "before", "after", "path")


def _classes() -> np.ndarray:
    """Letters without case, digits, other visible bytes, and space, as 38 classes."""
    table = np.full(256, 36, np.int64)
    table[97:123] = np.arange(26)
    table[65:91] = np.arange(26)
    table[48:58] = 26 + np.arange(10)
    table[:33] = 37
    return table


CLASS = _classes()
LETTER = np.zeros(256, np.uint8)
LETTER[97:123] = np.arange(97, 123)
LETTER[65:91] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


@dataclass
class Corpus:
    transition: np.ndarray  # log likelihood of a class after another
    frequent: np.ndarray    # word-hash buckets of dictionary words


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> Corpus:
    """Transitions and dictionary of all documents; a fixed number of counters comes back."""
    def run(batches):
        pairs, words = np.zeros(38 * 38, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            raw, at = buffer_of(batch.column(0))
            for a, b in slices(at, 1 << 18):
                part = raw[at[a]:at[b]]
                code = CLASS[part]
                pairs += np.bincount(code[:-1] * 38 + code[1:], minlength=38 * 38)
                low = LETTER[part]
                start, end, _ = word_bounds(low, at[a:b + 1] - at[a], np.arange(256) > 0)
                long = end - start >= 3
                hashed = range_hash(low.astype(np.uint64) + np.uint64(1), start[long], end[long])
                words += np.bincount((hashed >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
        have = np.flatnonzero(words)
        both = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[have, -1 - both]), pa.array(np.r_[words[have], pairs[both]])],
                                         ["slot", "n"])

    counted = (bounded_batches(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "slot long, n long")
               .groupBy("slot").agg(F.sum("n").alias("n")).collect())  # at most 2**18 + 38 * 38 rows
    pairs, words = np.ones((38, 38)), np.zeros(1 << BITS)
    for slot, n in counted:
        if slot < 0:
            pairs[(-1 - slot) // 38, (-1 - slot) % 38] += n
        else:
            words[slot] = n
    return Corpus(np.log(pairs / pairs.sum(axis=1, keepdims=True)), words >= max(20, 1e-6 * words.sum()))


# ------------------------------------------------------------------ candidates

@dataclass
class Candidate:
    start: int
    value: str
    before: str
    after: str
    assigned: bool


def candidates(text: str | None) -> list[Candidate]:
    """Candidates of a text in order; an assigned value wins over the token inside it."""
    if not text:
        return []
    found = {}
    for m in ASSIGNED.finditer(text):
        found[m.start(1)] = (m.end(1), True)
    taken = sorted((s, e) for s, (e, _) in found.items())
    k = 0
    for m in TOKEN.finditer(text):
        value = m.group()
        if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                or len(value) >= 16 and value.isupper()):
            continue
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        found[m.start()] = (m.end(), False)
    return [Candidate(s, text[s:e], text[max(0, s - 32):s], text[e:e + 16], assigned)
            for s, (e, assigned) in sorted(found.items())]


def _word(text: str, last: bool) -> str:
    words = re.findall(r"[^\W\d_]+", text.lower())
    return (words[-1] if last else words[0]) if words else ""


def measure(found: list[Candidate], corpus: Corpus) -> np.ndarray:
    """Features that do not depend on labels; the last three columns are left for neighbours and path."""
    out = np.zeros((len(found), len(FEATURES)))
    for i, c in enumerate(found):
        v, n = c.value, len(c.value)
        raw = np.frombuffer(v.encode("utf-8", "replace"), np.uint8)
        kind = [0 if x.isdigit() else 1 if x.isupper() else 2 if x.islower() else 3 for x in v]
        counts = Counter(v)
        code = CLASS[raw]
        steps = corpus.transition[code[:-1], code[1:]] if len(code) > 1 else np.zeros(1)
        out[i, :16] = (
            n, kind.count(0) / n, kind.count(1) / n, kind.count(2) / n, kind.count(3) / n, len(counts) / n,
            -sum(k / n * math.log2(k / n) for k in counts.values()),
            sum(a != b for a, b in zip(kind, kind[1:])) / n, steps.mean(), steps.min(), coverage(raw, corpus),
            bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", v)), c.assigned, c.before[-1:] in ("'", '"'), v.count("."),
            v.count("/") + (c.before[-1:] in ("/", "@")) + (c.after[:1] in ("/", "@")))
    return out


def coverage(raw: np.ndarray, corpus: Corpus, least: int = 3, most: int = 12) -> float:
    """Share of the bytes that dictionary words cover, longest first from the left."""
    low = LETTER[raw]
    n = len(low)
    start = np.repeat(np.arange(n), most - least + 1)
    end = start + np.tile(np.arange(least, most + 1), n)
    ok = end <= n
    start, end = start[ok], end[ok]
    bad = np.r_[0, np.cumsum(low == 0)]
    ok = bad[end] == bad[start]
    start, end = start[ok], end[ok]
    if not len(start):
        return 0.0
    known = corpus.frequent[(range_hash(low.astype(np.uint64) + np.uint64(1), start, end)
                             >> np.uint64(64 - BITS)).astype(np.int64)]
    longest: dict[int, int] = {}
    for s, e in zip(start[known].tolist(), end[known].tolist()):
        longest[s] = e
    at = covered = 0
    while at < n:
        end_ = longest.get(at, at)
        covered += end_ - at
        at = max(end_, at + 1)
    return covered / n


def weak_label(c: Candidate) -> int | None:
    if STRICT.fullmatch(c.value):
        return 1
    random_value = len(c.value) >= 12 and any(x.isdigit() for x in c.value) and len(set(c.value)) >= 8
    if c.assigned and random_value and not re.search(r"(?i)example|changeme|placeholder|your|xxxx", c.value):
        return 1
    if c.before[-1:] == "@" or c.after[:1] == "@" or re.search(r"(?i)\.(?:com|org|net|html?|json|txt|md)\b", c.value):
        return 0
    if re.fullmatch(r"[\d.+\-/]+|v?\d+(?:\.\d+)+\S*|[A-Za-z]+\d{0,4}", c.value) or not random_value:
        return 0
    return None


@dataclass
class Scanner:
    corpus: Corpus
    forest: forest.Forest
    before: dict[str, float]   # log odds of a secret by neighbour, and by path
    after: dict[str, float]
    path: dict[str, float]

    def complete(self, x: np.ndarray, before: list[str], after: list[str], path: list[str]) -> np.ndarray:
        for column, words, odds in ((16, before, self.before), (17, after, self.after), (18, path, self.path)):
            x[:, column] = [odds.get(w, 0.0) for w in words]
        return x

    def scores(self, found: list[Candidate], path: list[str]) -> np.ndarray:
        if not found:
            return np.zeros(0)
        x = self.complete(measure(found, self.corpus), [_word(c.before, True) for c in found],
                          [_word(c.after, False) for c in found], path)
        return self.forest.predict(x)


def _odds(words: list[str], label: np.ndarray) -> dict[str, float]:
    """Smoothed log odds of the words seen at least three times."""
    yes, no = Counter(), Counter()
    for w, y in zip(words, label):
        (yes if y else no)[w] += 1
    return {w: math.log((yes[w] + 1) / (no[w] + 1)) for w in {*yes, *no} if yes[w] + no[w] >= 3}


def path_words(path: str | None) -> str:
    return (path or "").rsplit("/", 1)[-1].lower()


CANDIDATES = "start int, value string, before string, after string, assigned boolean, measures array<double>"


def found_in(docs: DataFrame, corpus: Corpus, keep: list[Column], path: Column, text_col: str = "text") -> DataFrame:
    """A row per candidate: ``keep``, ``path``, the candidate, its neighbours and measures."""
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    chosen = bounded_batches(docs).select(F.struct(*keep).alias("kept"), path.cast("string").alias("path"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                here = candidates(text)
                rows += [i] * len(here)
                found += here
            x = measure(found, shared.value)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array([c.start for c in found], pa.int32()),
                 pa.array([c.value for c in found], pa.string()), pa.array([c.before for c in found], pa.string()),
                 pa.array([c.after for c in found], pa.string()), pa.array([c.assigned for c in found], pa.bool_()),
                 pa.array(list(x), pa.list_(pa.float64()))],
                ["kept", "path", "start", "value", "before", "after", "assigned", "measures"])

    kept = chosen.schema["kept"].dataType.simpleString()
    return chosen.mapInArrow(lean(run), f"kept {kept}, path string, {CANDIDATES}")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None,
        findings: DataFrame | None = None, most: int = MOST_FINDINGS) -> Scanner:
    """Train on labelled findings ``(id, start, label)``, or on weakly labelled ones."""
    path = F.lit(None).cast("string") if path is None else path
    corpus = corpus_statistics(docs, text_col)
    rows = found_in(docs, corpus, [F.col(id_col).alias("doc_id")], path, text_col)
    if findings is not None:
        known = findings.select(F.col(id_col).alias("of_id"), F.col("start").alias("at"), F.col("label").cast("int").alias("label"))
        rows = rows.join(known.dropDuplicates(["of_id", "at"]),
                         (F.col("kept.doc_id") == F.col("of_id")) & (F.col("start") == F.col("at")))
    else:
        def label(batches):
            for batch in batches:
                table = batch.to_pydict()
                marks = [weak_label(Candidate(s, v, b, a, g)) for s, v, b, a, g in
                         zip(table["start"], table["value"], table["before"], table["after"], table["assigned"])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int32())],
                                                 [*batch.schema.names, "label"])

        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        rows = rows.mapInArrow(lean(label), f"{columns}, label int")
    rows = rows.filter("label in (0, 1)").select(
        "path", "start", "value", "before", "after", "assigned", "measures", "label",
        F.pmod(F.xxhash64("value", "before", "after"), F.lit(1_000_000)).alias("draw"))
    rows = cut(rows.dropDuplicates(["value", "before", "after"]))
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    share = {k: min(1.0, most / n) for k, n in counts.items()}
    drawn = rows.filter(F.col("draw") < 1_000_000 * F.when(F.col("label") == 1, F.lit(share.get(1, 0.0)))
                        .otherwise(F.lit(share.get(0, 0.0)))).collect()  # about ``most`` of each label
    drawn = sorted(drawn, key=lambda r: (r.draw, r.value, r.before, r.after))
    y = np.array([r.label for r in drawn], np.int64)
    before, after = [_word(r.before, True) for r in drawn], [_word(r.after, False) for r in drawn]
    paths = [path_words(r.path) for r in drawn]
    scanner = Scanner(corpus, forest.Forest([]), _odds(before, y), _odds(after, y), _odds(paths, y))
    x = np.array([r.measures for r in drawn]).reshape(len(drawn), len(FEATURES))
    scanner.forest = forest.fit(scanner.complete(x, before, after, paths), y)
    return scanner


def scan(docs: DataFrame, scanner: Scanner, keep: list[Column], path: Column | None = None, text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """A row per candidate: ``keep``, ``start`` (characters), ``value``, ``score`` and ``secret``."""
    path = F.lit(None).cast("string") if path is None else path
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    chosen = bounded_batches(docs).select(F.struct(*keep).alias("kept"), path.cast("string").alias("path"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                here = candidates(text)
                rows += [i] * len(here)
                found += here
            paths = [path_words(p) for p in batch.column(1).take(pa.array(rows, pa.int64())).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([c.start for c in found], pa.int32()),
                 pa.array([c.value for c in found], pa.string()), pa.array(shared.value.scores(found, paths), pa.float64())],
                ["kept", "start", "value", "score"])

    kept = chosen.schema["kept"].dataType.simpleString()
    return (chosen.mapInArrow(lean(run), f"kept {kept}, start int, value string, score double")
            .select("kept.*", "start", "value", "score", (F.col("score") >= threshold).alias("secret")))


def redact(docs: DataFrame, scanner: Scanner, path: Column | None = None, text_col: str = "text",
           threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """All rows and columns, with the secrets of the text masked; null texts stay null."""
    path = F.lit(None).cast("string") if path is None else path
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    chosen = bounded_batches(docs).select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col])
                         .alias("kept"), path.cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            rows, found = [], []
            for i, text in enumerate(texts):
                here = candidates(text)
                rows += [i] * len(here)
                found += here
            paths = [path_words(p) for p in batch.column(1).take(pa.array(rows, pa.int64())).to_pylist()]
            scores = shared.value.scores(found, paths)
            # From the last to the first, so that earlier places keep their offsets.
            for k in range(len(found) - 1, -1, -1):
                if scores[k] >= threshold:
                    c, i = found[k], rows[k]
                    texts[i] = texts[i][:c.start] + mask + texts[i][c.start + len(c.value):]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["kept", "text"])

    kept = chosen.schema["kept"].dataType.simpleString()
    done = chosen.mapInArrow(lean(run), f"kept {kept}, text string")
    numbers = {c: i for i, c in enumerate(docs.columns)}
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"kept.c{numbers[c]}").alias(c)
                         for c in docs.columns])
