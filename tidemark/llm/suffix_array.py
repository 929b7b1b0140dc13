"""Removal of repeated byte strings with suffix arrays.

Shards of candidate bytes (see ``windows``) are indexed by suffix arrays: suffixes are ordered by
their first symbols, and unsorted groups are refined by the rank of the suffix that starts where
the known prefix ends, doubling it each round (Larsson-Sadakane); sorted groups are not touched
again.  Common prefixes come from
Kasai's algorithm, run over all segments of a shard side by side.  Windows whose neighbours share
their whole length repeat.  Shards are merged by binary search.

Defined cases: null is the empty text; texts shorter than the string lose nothing; equal texts at
least that long lose everything; strings never cross texts; repeated rows are separate texts; an
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import windows
from tidemark.llm.common import buffer_of
from tidemark.llm.windows import Spec, Symbols

LENGTH = 400
GRAM = 32


def refine(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols below 512.

    A rank is the place of the last member of a suffix's group; groups of one are sorted.
    """
    n = len(text)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | padded[k:k + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    edge = np.flatnonzero(np.r_[ordered[1:] != ordered[:-1], True])
    sizes = np.diff(np.r_[-1, edge])
    rank[order] = np.repeat(edge, sizes)
    # Places in the order that belong to groups of several suffixes.
    open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))
    known = 7
    while len(open_):
        members = order[open_]
        group = rank[members]
        following = rank[np.minimum(members + known, n)]
        both = group * np.int64(n + 1) + following + 1
        by = np.argsort(both, kind="stable")
        both, members = both[by], members[by]
        order[open_] = members
        last = np.r_[both[1:] != both[:-1], True]
        ends = np.flatnonzero(last)
        sizes = np.diff(np.r_[-1, ends])
        rank[members] = np.repeat(open_[ends], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        known *= 2
    return order


def kasai(text: np.ndarray, order: np.ndarray, lanes: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of every suffix with the one before it in the order, up to ``limit``.

    Kasai's walk drops one symbol per step and never restarts the comparison.  The walks over all
    lanes (a start and a size each) go on together, each in text order.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(limit + 1, text.dtype)])
    common = np.zeros(n, np.int32)
    place, left = lanes.copy(), sizes.copy()
    have = np.zeros(len(lanes), np.int64)
    live = np.flatnonzero(left > 0)
    while len(live):
        at, h = place[live], have[live]
        other = before[at]
        same = (other >= 0) & (h < limit)
        same &= padded[at + h] == padded[np.maximum(other, 0) + h]
        same &= np.maximum(other, 0) + h < n
        have[live] = h + same
        done = live[~same]
        if len(done):
            common[place[done]] = have[done]
            have[done] = np.maximum(have[done] - 1, 0)
            place[done] += 1
            left[done] -= 1
            if (left[done] == 0).any():
                live = live[left[live] > 0]
    return common


def repeated_starts(spec: Spec, sym: Symbols, weights: np.ndarray) -> np.ndarray:
    """Flag per byte: a window starts here whose bytes occur again among the weighted segments."""
    rows = len(sym.at) - 1
    sizes = np.diff(sym.at)
    # A separator follows every segment, so windows, which never reach it, compare within segments.
    text = np.zeros(len(sym.ids) + rows, np.uint16)
    shift = np.repeat(np.arange(rows), sizes)
    text[np.arange(len(sym.ids)) + shift] = sym.raw.astype(np.uint16) + 1
    lanes = sym.at[:-1] + np.arange(rows)
    order = refine(text)
    starts = np.maximum(sizes - spec.width + 1, 0)
    common = kasai(text, order, lanes, starts, spec.width)
    is_start = np.zeros(len(text), bool)
    owner = np.zeros(len(text), np.int64)
    place = np.repeat(lanes, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    is_start[place] = True
    owner[place] = np.repeat(np.arange(rows), starts)
    # A class is a stretch of the order whose members agree over the whole window.
    class_of = np.cumsum(~((common[order] >= spec.width) & is_start[order]))
    weight = np.bincount(class_of, weights=np.where(is_start[order], weights[owner[order]], 0))
    again = np.zeros(len(text), bool)
    again[order] = (weight[class_of] > 1) & is_start[order]
    return again[np.arange(len(sym.ids)) + shift]


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
          shard: int = windows.SHARD, hot: int = windows.HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_spans, removed, kept)`` of every row; ``kept`` is binary."""
    spec = Spec(words=False, width=length, gram=gram)
    rows = windows.keyed(docs, id_col, text_col)
    marked = windows.with_spans(rows, windows.repeated(spec, rows, repeated_starts, shard, hot))

    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(1))
            spans = batch.column(2)
            size, removed, count, kept = np.diff(at), [], [], []
            for i in range(batch.num_rows):
                text = raw[at[i]:at[i + 1]]
                if not spans[i].is_valid:
                    removed.append(0)
                    count.append(0)
                    kept.append(text.tobytes())
                    continue
                gone = windows.covered(len(text), spans[i].as_py())
                removed.append(int(gone.sum()))
                count.append(int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()))
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(count, pa.int64()),
                                              pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "n_spans", "n_removed", "kept"])

    return marked.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_spans long, n_removed long, kept binary")


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()
