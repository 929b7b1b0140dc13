"""SimHash near-duplicates: exact tiled comparison of distinct fingerprints.

Fingerprints are compared in tiles with exclusive-or and bit counts.  A tile pair whose
population counts differ by more than the radius is skipped.  Tiles meet only within blocks of
fingerprints that agree on some of the bit groups; for a radius r and more than r groups, every
linked pair agrees on at least (groups - r) of them, so no link is lost.

Defined cases: null and wordless texts have fingerprint zero and link like any other; texts
with fewer words than the shingle are one shingle; repeated rows share a fingerprint; a null id
is never the smallest id while another id is in its component; an empty table gives no rows.
Only the id and text columns are read, so other columns of any name are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, buffer_of, components, cut, lean
from tidemark.llm.decontaminate import small

SEED = 42
TILE = 1024
#: Blocks with more distinct fingerprints than this are dealt out as tile pairs.
LARGE_BLOCK = 20_000


def shingle_hashes(text: bytes, width: int, seed: int = SEED) -> np.ndarray:
    """Hashes of all shingles of ``width`` words, repeats included; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]][:max(len(words) - width + 1, 1)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[min(width, len(words)) - 1:])], np.uint64)


def fingerprint(text: bytes, width: int, seed: int = SEED) -> int:
    """Majority of the hash bits over all shingles; zero without words."""
    return majority(shingle_hashes(text, width, seed))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row."""
    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(1))
            data = raw.tobytes()
            fp = np.array([fingerprint(data[at[i]:at[i + 1]], width) for i in range(batch.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))],
                                             ["doc_id", "fp"])

    return (bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lean(run), "doc_id long, fp long"))


# ------------------------------------------------------------------ tiles

def linked(radius: int):
    """Links within a tile, or between two, as a spanning forest: at most one per member."""
    def compare(a: list[np.ndarray], b: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        one, other = a[0].view(np.uint64), (a if b is None else b)[0].view(np.uint64)
        near = np.bitwise_count(one[:, None] ^ other[None, :]) <= radius
        if b is None:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            return a[0][:0], a[0][:0]
        both = a[0] if b is None else np.concatenate([a[0], b[0]])
        label = components(len(both), i, j if b is None else j + len(a[0]))
        moved = np.flatnonzero(label != np.arange(len(both)))
        return both[label[moved]], both[moved]

    return compare


def _beyond(a: np.ndarray, b: np.ndarray, radius: int) -> bool:
    """Whether the population counts of two tiles lie further apart than the radius."""
    return int(b.min()) - int(a.max()) > radius or int(a.min()) - int(b.max()) > radius


def _edges(found) -> pa.RecordBatch:
    parts = list(found)
    none = np.zeros(0, np.int64)
    a = np.concatenate([none, *[p[0] for p in parts]])
    b = np.concatenate([none, *[p[1] for p in parts]])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _numbers(batch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def sweep(radius: int, compare, tile: int = TILE):
    """Compare a stream sorted by block: a tile meets the tiles its first block reaches back to.

    Rows are (block, fingerprint, anything else); ``compare`` gets the columns after the block.
    """
    def run(batches):
        waiting: list[tuple[np.ndarray, list[np.ndarray], np.ndarray]] = []
        for batch in batches:
            block, *columns = _numbers(batch)
            found = []
            for s in range(0, len(block), tile):
                keys, now = block[s:s + tile], [c[s:s + tile] for c in columns]
                counts = np.bitwise_count(now[0].view(np.uint64))
                waiting = [w for w in waiting if w[0][-1] == keys[0]]
                mine = keys == keys[0]
                for key, seen, pops in waiting:
                    theirs = key == keys[0]
                    if not _beyond(pops[theirs], counts[mine], radius):
                        found.append(compare([c[theirs] for c in seen], [c[mine] for c in now]))
                found.append(compare(now, None))
                waiting.append((keys, now, counts))
            if found:
                yield _edges(found)

    return run


def grid(compare):
    """Compare the two sides of tile pairs: rows (pair, side, ...) come sorted by pair, then side."""
    def run(batches):
        held: dict = {}
        key = None

        def settle():
            sides = [[np.concatenate(c) for c in zip(*held[s])] if held.get(s) else None for s in (0, 1)]
            for s in range(0, len(sides[0][0]) if sides[0] else 0, TILE):
                left = [c[s:s + TILE] for c in sides[0]]
                if sides[1] is None:
                    yield compare(left, None)
                    for t in range(s + TILE, len(sides[0][0]), TILE):
                        yield compare(left, [c[t:t + TILE] for c in sides[0]])
                else:
                    for t in range(0, len(sides[1][0]), TILE):
                        yield compare(left, [c[t:t + TILE] for c in sides[1]])

        for batch in batches:
            pair, side, *columns = _numbers(batch)
            starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (side[1:] != side[:-1])]) if len(pair) else []
            for s, e in zip(starts, [*starts[1:], len(pair)]):
                if pair[s] != key:
                    if key is not None:
                        yield _edges(settle())
                    held, key = {}, pair[s]
                held.setdefault(int(side[s]), []).append([c[s:e] for c in columns])
        if key is not None:
            yield _edges(settle())

    return run


def compared(blocks: DataFrame, radius: int, compare, large: int = LARGE_BLOCK) -> DataFrame:
    """Links ``(a, b)`` that ``compare`` finds between rows of equal ``block``.

    Blocks above ``large`` rows are cut into tiles by population count and hash, and every pair of
    tiles within the radius becomes a group of its own, so no task holds more than two tiles.
    """
    others = [c for c in blocks.columns if c not in ("block", "fp")]
    sizes = cut(blocks.groupBy(F.col("block").alias("big")).count().filter(F.col("count") > large))
    some = bool(sizes.head(1))
    usual = blocks.join(sizes, blocks.block == sizes.big, "left_anti") if some else blocks
    found = (usual.select("block", "fp", *others).repartition("block").sortWithinPartitions("block", F.bit_count("fp"))
             .mapInArrow(lean(sweep(radius, compare)), "a long, b long"))
    if not some:
        return found
    big = blocks.join(sizes, blocks.block == sizes.big).select("block", "fp", *others, F.bit_count("fp").alias("pop"))
    spread = cut(big.groupBy(F.col("block").alias("in_block"), F.col("pop").alias("other")).agg(
        F.ceil(F.count("*") / (4 * TILE)).cast("int").alias("cells")))
    own = spread.select(F.col("in_block").alias("own_block"), F.col("other").alias("own_pop"),
                        F.col("cells").alias("own_cells"))
    near = big.join(own, (F.col("block") == F.col("own_block")) & (F.col("pop") == F.col("own_pop")))
    near = near.withColumn("cell", F.pmod(F.xxhash64("fp", *others), F.col("own_cells")).cast("int"))
    rows = near.join(spread, (F.col("block") == F.col("in_block"))
                     & (F.col("other").between(F.col("pop") - radius, F.col("pop") + radius)))
    rows = rows.withColumn("other_cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    mine = F.struct(F.col("pop").alias("pop"), F.col("cell").alias("cell"))
    theirs = F.struct(F.col("other").alias("pop"), F.col("other_cell").alias("cell"))
    pairs = rows.select(F.xxhash64("block", F.least(mine, theirs), F.greatest(mine, theirs)).alias("pair"),
                        F.when(mine <= theirs, 0).otherwise(1).alias("side"), "fp", *others)
    dealt = pairs.repartition("pair").sortWithinPartitions("pair", "side")
    return found.unionByName(dealt.mapInArrow(lean(grid(compare)), "a long, b long"))


def links(fps: DataFrame, radius: int, groups: int | None = None, large: int = LARGE_BLOCK) -> DataFrame:
    """A spanning set of links ``(a, b)`` between distinct fingerprints within ``radius``.

    ``groups`` bit groups are cut; blocks agree on all but ``radius`` of them.
    """
    groups = groups or radius + 1
    cuts = [64 * i // groups for i in range(groups + 1)]
    masks = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(groups)]
    kept = []
    for chosen in combinations(range(groups), groups - radius):
        mask = sum(masks[i] for i in chosen)
        kept.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    blocks = fps.select(
        F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long")))
                            for k, m in enumerate(kept)])).alias("block"), "fp")
    return compared(blocks, radius, linked(radius), large)


def connect(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node reachable over ``(a, b)``, for every node but the roots.

    Alternates large-star and small-star steps; each takes a minimum per node (combined before
    the shuffle) and one join, and is cut in the shared folder.  Rounds grow with the logarithm of the
    longest chain; the last one changes nothing.
    """
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")).withColumnRenamed("a", "n")
        large = (both.join(low, both.a == low.n).filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "n")
        small = large.join(low, large.a == low.n)
        edges = cut(small.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                                                   F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
                    .select("e.a", "e.b").filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, groups: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id reachable over fingerprints within the radius."""
    fps = cut(fingerprints(docs, width, id_col, text_col))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connect(links(distinct.select("fp"), radius, groups))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("class"))
    ids = grouped.groupBy("class").agg(F.min("first_id").alias("component_id")).withColumnRenamed("class", "of_class")
    named = grouped.join(ids, grouped["class"] == ids.of_class).select(F.col("fp").alias("of_fp"), "component_id")
    return fps.join(named, fps.fp == named.of_fp).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` without the rows whose component holds a row of smaller id (null last, then text hash).

    Rows of one id and text go or stay together.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    me = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"))
    # Equal texts have equal fingerprints, so the text's hash is the name that a fingerprint is found by.
    named = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
    fps = cut(fingerprints(named, width, "text_hash", "text").withColumnRenamed("doc_id", "of_text").distinct())
    roots = connect(links(fps.select("fp").distinct(), radius))
    classes = fps.join(roots, fps.fp == roots.node, "left").select("of_text", F.coalesce("root", "fp").alias("class"))
    rows = docs.select(me.alias("me")).distinct().join(classes, F.col("me.text_hash") == F.col("of_text")).select("me", "class")
    stay = rows.groupBy(F.col("class").alias("of_class")).agg(F.min("me").alias("stays"))
    gone = cut(rows.join(stay, F.col("class") == F.col("of_class")).filter("me <> stays").select(
        F.col("me.id").alias("gone_id"), F.col("me.text_hash").alias("gone_text")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("gone_id")) & (F.xxhash64(text) == F.col("gone_text"))
    return docs.join(small(gone), same, "left_anti")
