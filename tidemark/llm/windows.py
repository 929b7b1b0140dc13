"""Repeated windows of a fixed number of symbols over a whole corpus, exactly.

A window is ``width`` consecutive symbols (bytes or words) of one text; it is repeated if the same
symbols start anywhere else.  Every window has an anchor: the least hash of its grams.  Equal
windows have equal anchors, so windows whose anchor occurs once in the corpus need no further
look, and the others meet by their anchor.  Consecutive windows with one anchor form a segment.

1. Anchors are counted over the corpus; those that occur once are dropped.
2. Segments with a shared anchor are grouped by content; one copy of each content is fetched, with
   its weight (one, or two for several).
3. Contents are dealt by ranges of anchors in shards of bounded size; an indexer (suffix arrays or
   suffix trees) finds in every shard the windows that repeat.  An anchor whose contents exceed
   ``HOT`` bytes is split over several shards; its windows also leave each shard as fingerprints,
   and a merge by binary search over all shards settles them.
4. Repeated windows become spans of their documents; a last pass applies them.

So a hot anchor never meets in one task beyond that bound; a hot content is one row with a weight;
the joins are plain ones that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (IS_WORD, _BYTE, bounded_batches, buffer_of, cut, mix, range_hash, slices, window_min, word_bounds)

#: Longest run of window starts in one segment.
PIECE = 4096
#: Bytes of content in a shard.
SHARD = 1 << 20
#: Bytes of content of one anchor that stay together.
HOT = 5 << 19
#: Symbols that are hashed at a time.
CHUNK = 1 << 18


@dataclass(frozen=True)
class Spec:
    """What is indexed: bytes or words, the window and the gram that anchors are chosen from."""

    words: bool
    width: int
    gram: int


@dataclass
class Symbols:
    """Symbols of some rows: identities, row offsets, and their bounds in the bytes."""

    ids: np.ndarray
    at: np.ndarray
    raw: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None


def symbols(spec: Spec, raw: np.ndarray, offsets: np.ndarray) -> Symbols:
    if not spec.words:
        return Symbols(_BYTE[raw], offsets, raw)
    start, end, row = word_bounds(raw, offsets, IS_WORD)
    at = np.searchsorted(row, np.arange(len(offsets)))
    return Symbols(range_hash(_BYTE[raw], start, end), at, raw, start, end)


def gram_hash(ids: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` consecutive identities at every place, by doubling."""
    n = len(ids) - length + 1
    if n <= 0:
        return ids[:0]
    power, size, out, done = ids, 1, None, 0
    while True:
        if length & size:
            if out is None:
                out = power
            else:
                keep = len(ids) - done - size + 1
                out = out[:keep] * np.uint64(0xC2B2AE3D27D4EB4F) + mix(power[done:done + keep])
            done += size
        if size * 2 > length:
            return mix(out[:n])
        power = power[:-size] * np.uint64(0x9E3779B185EBCA87 + 2 * size) + power[size:]
        size *= 2


@dataclass
class Segments:
    row: np.ndarray
    anchor: np.ndarray
    content: np.ndarray   # hash of the symbols
    start: np.ndarray     # first window start, in symbols of the row
    count: np.ndarray     # window starts
    twice: np.ndarray     # whether the anchor occurs more than once inside


def segments(spec: Spec, sym: Symbols, piece: int = PIECE) -> Segments:
    ids, at, width = sym.ids, sym.at, spec.width
    grams = width - spec.gram + 1
    n = len(ids) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Segments(none, none.astype(np.uint64), none.astype(np.uint64), none, none, none.astype(bool))
    g = gram_hash(ids, spec.gram)
    low = window_min(g, grams)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    valid = row[:n] == row[width - 1:]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (row[1:n] != row[:n - 1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    if not len(first):
        return Segments(none, none.astype(np.uint64), none.astype(np.uint64), none, none, none.astype(bool))
    # A run ends before the next break or before the first invalid start.
    breaks = np.append(np.flatnonzero(new | ~valid), n)
    last = breaks[np.searchsorted(breaks, first, "right")] - 1
    parts = (last - first) // piece + 1
    if (parts > 1).any():
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, last = np.repeat(first, parts) + step * piece, np.repeat(last, parts)
        last = np.minimum(last, first + piece - 1)
    anchor = low[first]
    # Places whose gram is least in some window around them, to count the anchor inside segments.
    high = np.full(n + 2 * (grams - 1), 0, np.uint64)
    high[grams - 1:grams - 1 + n] = low
    least = np.flatnonzero(~window_min(~high, grams) == g)
    lo, hi = np.searchsorted(least, first), np.searchsorted(least, last + grams)
    size = hi - lo
    owner = np.repeat(np.arange(len(first)), size)
    place = least[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]
    twice = np.bincount(owner[g[place] == anchor[owner]], minlength=len(first)) > 1
    content = range_hash(ids, first, last + width)
    of = row[first]
    return Segments(of, anchor, content, first - at[of], last - first + 1, twice)


def _each(spec: Spec, column):
    """Symbols and rows of a text column, a bounded number of bytes at a time."""
    raw, at = buffer_of(column)
    for a, b in slices(at, CHUNK * (4 if spec.words else 1)):
        part = raw[at[a]:at[b]]
        yield a, part, symbols(spec, part, at[a:b + 1] - at[a])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def shared_anchors(spec: Spec, docs: DataFrame) -> DataFrame:
    """Anchors that occur more than once in the corpus."""
    def run(batches):
        for batch in batches:
            for _, _, sym in _each(spec, batch.column(0)):
                found = segments(spec, sym)
                anchor, place = np.unique(found.anchor, return_inverse=True)
                times = np.bincount(place, weights=1 + found.twice, minlength=len(anchor))
                yield pa.RecordBatch.from_arrays([_signed(anchor), pa.array(np.minimum(times, 2).astype(np.int32))],
                                                 ["anchor", "times"])

    counted = docs.select("text").mapInArrow(run, "anchor long, times int").groupBy("anchor").agg(F.sum("times").alias("n"))
    return counted.filter("n > 1").select(F.col("anchor").alias("shared"))


def occurrences(spec: Spec, docs: DataFrame) -> DataFrame:
    """Every segment of every row."""
    def run(batches):
        for batch in batches:
            for a, _, sym in _each(spec, batch.column(2)):
                found = segments(spec, sym)
                rows = pa.array(found.row + a)
                yield pa.RecordBatch.from_arrays(
                    [_signed(found.anchor), _signed(found.content), batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(found.start.astype(np.int32)), pa.array(found.count.astype(np.int32))],
                    ["anchor", "content", "doc_id", "text_hash", "start", "count"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, "anchor long, content long, doc_id long, text_hash long, start int, count int")


def contents(spec: Spec, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The symbols of the wanted segments, as bytes (words joined by one space)."""
    joined = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.in_doc) & (docs.text_hash == wanted.in_text))

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            ends = np.cumsum(np.asarray(lists.value_lengths()))
            fields = {f: flat.field(i) for i, f in enumerate(("anchor", "content", "start", "count", "weight", "salt"))}
            start = np.asarray(fields["start"]).astype(np.int64)
            stop = start + np.asarray(fields["count"]) + spec.width - 1
            for a, part, sym in _each(spec, batch.column(0)):
                rows = len(sym.at) - 1
                lo, hi = (ends[a - 1] if a else 0), ends[a + rows - 1]
                base = sym.at[np.searchsorted(ends, np.arange(lo, hi), "right") - a]
                s, e = start[lo:hi] + base, stop[lo:hi] + base
                data = part.tobytes()
                if spec.words:
                    bounds = list(zip(sym.start[s].tolist(), sym.end[e - 1].tolist()))
                    texts = [b" ".join(data[x:y].split()) for x, y in bounds]
                else:
                    texts = [data[x:y] for x, y in zip(s.tolist(), e.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(fields[f][lo:hi] for f in ("anchor", "content", "weight", "salt")), pa.array(texts, pa.binary())],
                    ["anchor", "content", "weight", "salt", "symbols"])

    return joined.select("text", "wanted").mapInArrow(run, "anchor long, content long, weight int, salt int, symbols binary")


#: Finds the window starts that repeat among segments: (spec, symbols, weights) -> flag per window.
Index = Callable[[Spec, Symbols, np.ndarray], np.ndarray]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


RUNS = "array<struct<a:int,b:int>>"


PRINTS = "array<struct<place:int,print:bigint>>"


def indexed(spec: Spec, sorted_contents: DataFrame, index: Index, shard: int = SHARD) -> DataFrame:
    """Runs of repeated window starts of every content, and fingerprints of split anchors.

    Contents come sorted by anchor and salt; a shard ends where these change.  Of the windows that
    repeat within a shard one fingerprint stands for all.
    """
    runs_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    prints_type = pa.list_(pa.struct([("place", pa.int32()), ("print", pa.int64())]))

    def settle(anchor, content, weight, salt, texts):
        raw = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        sym = symbols(spec, raw, offsets)
        again = index(spec, sym, np.array(weight))
        starts = np.maximum(np.diff(sym.at) - spec.width + 1, 0)
        runs, prints, told = [], [], {}
        for i, (at, n) in enumerate(zip(sym.at.tolist(), starts.tolist())):
            runs.append([{"a": a, "b": b} for a, b in _runs(again[at:at + n])])
            if salt[i] < 0:
                prints.append(None)
                continue
            places = np.arange(n)
            value = range_hash(sym.ids[at:at + n + spec.width - 1], places, places + spec.width).view(np.int64)
            seen = told.setdefault(anchor[i], set())
            send = []
            for place, v, known in zip(places.tolist(), value.tolist(), again[at:at + n].tolist()):
                if not known or v not in seen:
                    send.append({"place": place, "print": v})
                    seen.add(v)
            prints.append(send)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(runs, runs_type),
             pa.array(prints, prints_type)], ["anchor", "content", "runs", "prints"])

    def run(batches):
        held, size = ([], [], [], [], []), 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= shard and (row[0], row[3]) != (held[0][-1], held[3][-1]):
                    yield settle(*held)
                    held, size = ([], [], [], [], []), 0
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[4])
        if held[0]:
            yield settle(*held)

    return sorted_contents.mapInArrow(run, f"anchor long, content long, runs {RUNS}, prints {PRINTS}")


def merged(found: DataFrame) -> DataFrame:
    """Window starts of split anchors that also occur in another shard, by binary search.

    Fingerprints are dealt by anchor and value; a task sorts what it gets once and looks every
    fingerprint up.
    """
    rows = found.filter("size(prints) > 0").select("anchor", "content", F.explode("prints").alias("p"))
    rows = rows.select("anchor", "content", "p.place", "p.print").repartition("anchor", "print")

    def run(batches):
        table = [batch for batch in batches if batch.num_rows]
        if not table:
            return
        whole = pa.Table.from_batches(table)
        column = [whole.column(i).to_numpy() for i in range(4)]
        key = mix(column[0].view(np.uint64)) ^ column[3].view(np.uint64)
        order = np.sort(key)
        again = np.searchsorted(order, key, "right") - np.searchsorted(order, key, "left") > 1
        if again.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[again]) for c in column], ["anchor", "content", "place", "print"])

    hits = rows.mapInArrow(run, "anchor long, content long, place int, print long")
    return hits.select("anchor", "content", F.array(F.struct(F.col("place").alias("a"), (F.col("place") + 1).alias("b")))
                       .alias("runs"))


def repeated(spec: Spec, docs: DataFrame, index: Index, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """``(in_doc, in_text, spans)``: symbol ranges covered by repeated windows, for rows that have any.

    ``docs`` has ``doc_id``, ``text_hash`` and ``text``; ranges may touch or overlap.
    """
    shared = cut(shared_anchors(spec, docs))
    occ = occurrences(spec, docs)
    occ = cut(occ.join(shared, occ.anchor == shared.shared).drop("shared"))
    first = F.min(F.struct("doc_id", "text_hash", "start", "count")).alias("at")
    kinds = occ.groupBy("anchor", "content").agg(first, F.count("*").alias("n"))
    size = F.sum((F.col("at.count") + spec.width).cast("long") * (6 if spec.words else 1))
    large = cut(kinds.groupBy(F.col("anchor").alias("hot")).agg(size.alias("bytes")).filter(F.col("bytes") > hot))
    if large.head(1):
        kinds = kinds.join(large, F.col("anchor") == F.col("hot"), "left")
        salt = F.when(F.col("bytes").isNull(), -1).otherwise(F.pmod("content", F.ceil(F.col("bytes") / hot))).cast("int")
    else:
        salt = F.lit(-1)
    part = F.struct("anchor", "content", F.col("at.start").alias("start"), F.col("at.count").alias("count"),
                    F.least("n", F.lit(2)).cast("int").alias("weight"), salt.alias("salt"))
    wanted = kinds.groupBy(F.col("at.doc_id").alias("in_doc"), F.col("at.text_hash").alias("in_text")).agg(
        F.collect_list(part).alias("wanted"))
    fetched = contents(spec, docs, wanted)
    dealt = fetched.repartitionByRange("anchor", "salt").sortWithinPartitions("anchor", "salt", "content")
    found = cut(indexed(spec, dealt, index, shard))
    runs = found.filter("size(runs) > 0").select("anchor", "content", "runs").unionByName(merged(found))
    runs = runs.withColumnsRenamed({"anchor": "run_anchor", "content": "run_content"})
    spans = occ.join(runs, (occ.anchor == runs.run_anchor) & (occ.content == runs.run_content))
    span = F.transform("runs", lambda r: F.struct((F.col("start") + r.a).alias("a"),
                                                  (F.col("start") + r.b + (spec.width - 1)).alias("b")))
    return (spans.select("doc_id", "text_hash", span.alias("spans"))
            .groupBy(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text"))
            .agg(F.flatten(F.collect_list("spans")).alias("spans")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and a hash of it; the id and the hash name a row up to equal rows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row with its spans, null for none."""
    return docs.join(spans, docs.doc_id.eqNullSafe(spans.in_doc) & (docs.text_hash == spans.in_text), "left")


def covered(n: int, spans: list | None) -> np.ndarray:
    """Flags of the symbols that lie in a span."""
    change = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(change, [s["a"] for s in spans], 1)
        np.add.at(change, [s["b"] for s in spans], -1)
    return np.cumsum(change[:n]) > 0
