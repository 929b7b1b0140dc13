"""Quality rules with risk-controlled cutoffs.

Every text is measured; a rule rejects a text whose measure exceeds a cutoff.  Labelled rows are
split: the training part nominates, for each stratum and rule, the cutoff of a fixed ladder that
best tells low quality from good, or none.  The holdout decides.  With k of its n good texts
rejected, a nominee is used only if the exact binomial tail P(X <= k | n, a) is at most ``DELTA``
over the number of nominees (Bonferroni), where ``a`` is the stratum's allowance for false
rejection divided among its nominees.  So with probability 1 - DELTA no stratum loses more than
``ALLOWED`` of its good texts.  Strata with too few labels certify nothing and reject nothing.

Defined cases: null and wordless texts have no words and fail the base; null labels are ignored,
an id with several labels counts as low quality if one of them is; a null stratum is one of its
own; repeated rows are measured alike; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import IS_WORD, _BYTE, bounded_batches, buffer_of, cut, mix, range_hash, slices, word_bounds

ALLOWED = 0.05
DELTA = 0.05
#: Good texts rejected weigh so many times low-quality texts rejected when a cutoff is chosen.
CARE = 5.0
MOST_STRATA = 1000
RULES = ("symbols", "repeats", "lines", "capitals", "marks", "length")
#: Ladder of cutoffs for all measures, which lie between 0 and 1.
LADDER = tuple(round(0.02 * 1.14 ** i, 6) for i in range(30))
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SYMBOL = _flags(b"#*$%&|<>")
CAPITAL = _flags(bytes(range(65, 91)))
MARK = _flags(b"!?=@")
HEAD = (np.arange(256) & 0xC0) != 0x80


def _per_row(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _seen_before(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items in order: whether an equal one of the row precedes, and whether one exists at all."""
    both = mix(key + mix(row.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    again, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return again, any_


def measure(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The counts of ``FIELDS`` for every row."""
    rows = len(at) - 1
    out = np.zeros((len(FIELDS), rows), np.int64)
    start, end, row = word_bounds(raw, at, IS_WORD)
    out[0] = np.bincount(row, minlength=rows)
    inside = IS_WORD[raw]
    out[1] = _per_row(inside & HEAD[raw], at)
    out[2] = _per_row(SYMBOL[raw], at)
    out[6] = _per_row(CAPITAL[raw], at)
    out[7] = _per_row(MARK[raw], at)
    values = _BYTE[raw]
    if len(start):
        # Lines: cut at line feeds and rows; only those with a word count.
        breaks = np.flatnonzero(raw == 10)
        begin = np.unique(np.r_[at[:-1], breaks + 1])
        begin = begin[begin < len(raw)]
        stop = np.r_[begin[1:], len(raw)]
        stop = stop - (raw[stop - 1] == 10)
        stop = np.maximum(stop, begin)
        has = np.searchsorted(start, stop) > np.searchsorted(start, begin)
        begin, stop = begin[has], stop[has]
        of = np.searchsorted(at, begin, "right") - 1
        again, _ = _seen_before(of, range_hash(values, begin, stop))
        out[3] = np.bincount(of[again], minlength=rows)
        out[5] = np.bincount(of, minlength=rows)
    if len(start) > 2:
        word = range_hash(values, start, end)
        three = mix(mix(word[:-2] + np.uint64(1)) + mix(word[1:-1] + np.uint64(2)) * np.uint64(3) + word[2:])
        whole = np.flatnonzero(row[:-2] == row[2:])
        _, twice = _seen_before(row[whole], three[whole])
        covered = np.zeros(len(start), bool)
        hit = whole[twice]
        for k in range(3):
            covered[hit + k] = True
        out[4] = np.bincount(row[covered], minlength=rows)
    return out


def measures(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    chosen = bounded_batches(docs).select(F.struct(*keep).alias("kept"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(1))
            parts = [measure(raw[at[a]:at[b]], at[a:b + 1] - at[a]) for a, b in slices(at, 1 << 18)]
            counts = np.concatenate(parts, axis=1) if parts else np.zeros((len(FIELDS), 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in counts]], ["kept", *FIELDS])

    kept = chosen.schema["kept"].dataType.simpleString()
    return chosen.mapInArrow(run, f"kept {kept}, {SCHEMA}").select("kept.*", *FIELDS)


def _share(part: Column, whole: Column) -> Column:
    return F.least(part / F.greatest(whole, F.lit(1)), F.lit(1.0))


def rule_values() -> dict[str, Column]:
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbols": _share(F.col("n_symbols"), words),
        "repeats": _share(F.col("n_repeat_words"), words),
        "lines": _share(F.col("n_dup_lines"), F.col("n_lines")),
        "capitals": _share(F.col("n_capitals"), chars),
        "marks": _share(F.col("n_marks"), words),
        "length": _share(chars, words * 20),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for a binomial X, exactly; 1 without trials."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    steps = np.zeros(k + 1)
    steps[1:] = np.log((n - i[:-1]) / (i[:-1] + 1.0)) + math.log(p) - math.log1p(-p)
    logs = n * math.log1p(-p) + np.cumsum(steps)
    top = logs.max()
    return min(1.0, float(math.exp(top) * np.exp(logs - top).sum()))


def certify(counts: dict, allowed: float = ALLOWED, delta: float = DELTA, care: float = CARE) -> dict:
    """Chosen cutoff of each (stratum, rule), from counts of texts by step of the ladder.

    ``counts[(stratum, rule)]`` is an array [holdout or not][good or not][steps + 1]: texts whose
    value passes exactly so many cutoffs.
    """
    nominees: dict = {}
    for (stratum, rule), c in counts.items():
        above = np.cumsum(c[:, :, ::-1], axis=2)[:, :, ::-1][:, :, 1:]   # texts beyond each cutoff
        total = np.maximum(c.sum(axis=2), 1)
        worth = above[0, 0] / total[0, 0] - care * above[0, 1] / total[0, 1]
        best = int(np.argmax(worth))
        if worth[best] > 0:
            nominees[stratum, rule] = (LADDER[best], int(above[1, 1, best]), int(c[1, 1].sum()))
    in_stratum: dict = {}
    for stratum, _ in nominees:
        in_stratum[stratum] = in_stratum.get(stratum, 0) + 1
    return {key: cutoff for key, (cutoff, k, n) in nominees.items()
            if n and tail(k, n, allowed / in_stratum[key[0]]) <= delta / len(nominees)}


def cutoffs(measured: DataFrame, labels: DataFrame, holdout: Column, id_col: str, label_col: str,
            most_strata: int = MOST_STRATA, **risk) -> dict:
    """Cutoffs per (stratum, rule).  ``measured`` has the id, ``stratum`` and the counts."""
    marks = (labels.select(F.col(id_col).alias("marked_id"), F.col(label_col).cast("int").alias("mark"))
             .filter("marked_id is not null and mark is not null").groupBy("marked_id").agg(F.min("mark").alias("mark")))
    # Texts that fail the base are decided already; the rules answer for the others.
    rows = measured.filter(~base_failed()).join(marks, F.col(id_col) == F.col("marked_id"))
    passed = [sum((v > F.lit(c)).cast("int") for c in LADDER).alias(r) for r, v in rule_values().items()]
    binned = rows.select("stratum", holdout.alias("held"), F.col("mark"), *passed)
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES])).alias("s")
    table = (binned.select("stratum", "held", "mark", steps).groupBy("stratum", "held", "mark", "s.rule", "s.step")
             .agg(F.count("*").alias("n")))
    most = most_strata * len(RULES) * (len(LADDER) + 1) * 4
    got = table.limit(most + 1).collect()
    if len({r.stratum for r in got}) > most_strata or len(got) > most:
        raise ValueError(f"more than {most_strata} strata")
    counts: dict = {}
    for r in got:
        c = counts.setdefault((r.stratum, r.rule), np.zeros((2, 2, len(LADDER) + 1), np.int64))
        c[int(r.held), int(r.mark != 0), r.step] += r.n
    return certify(counts, **risk)


def judge(docs: DataFrame, labels: DataFrame, stratum: Column, holdout: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", **risk) -> DataFrame:
    """Id, counts, ``base_failed`` and ``kept`` of every row."""
    measured = cut(measures(docs, [F.col(id_col).alias("doc_id"), stratum.cast("string").alias("stratum")], text_col))
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("quality"))
    chosen = cutoffs(measured, marks, holdout, "doc_id", "quality", **risk)
    values = rule_values()
    rejected = F.lit(False)
    for (s, rule), cutoff in sorted(chosen.items(), key=str):
        rejected = rejected | (F.col("stratum").eqNullSafe(F.lit(s)) & (values[rule] > F.lit(cutoff)))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)
