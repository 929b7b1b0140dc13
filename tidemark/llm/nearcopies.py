"""One document of every group of near copies, found by prefix filtering and verified exactly.

Near copies share at least ``SIMILARITY`` of their distinct five-word shingles (Jaccard).  Texts
with equal shingle sets are one class.  A class shows its shingles below a hash bound, a quarter of
all; if these are fewer than a fifth of its set and one more, those of half or of all hashes.  Of two
sets at the similarity the one with the smaller bound shows more shingles than it can lack in the
other, so both show a common one.  Shown shingles are counted over the whole corpus, exactly, and each
class orders its own by that count, unshared ones first.  Classes meet in blocks of shared shingles;
at their first common one, all that come before are missing in the other set, which bounds the
overlap.  No pair is lost, and a text with many shingles of its own meets nobody.

Candidates stay in their task: a tile sends a spanning forest of them, at most one link for each of
its classes.  Classes that candidates connect form a *cluster*; every pair of near copies lies
in one.  The shingle set of each class is fetched once, and clusters are verified in tiles of bounded
size: the overlaps of all pairs of a tile are one product of its incidence matrix with itself, and
again only a spanning forest of verified links leaves the task.  A cluster of several chunks first
meets its chunk 0 only, which settles one large group of copies in proportion to its size; then all
chunks meet the classes that are not in the cluster's largest group.

Defined cases: null, empty and wordless texts are copies of each other; texts with fewer words than
a shingle are one shingle; the smallest id of a group stays (null last), of equal ids the least
text hash, of repeated rows one; columns of any name pass through; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import bounded_batches, buffer_of, components, cut, lean, mix
from tidemark.llm.decontaminate import small

WIDTH = 5
SIMILARITY = 0.8
#: Hash bounds, a quarter and a half of all hashes; beyond the last a class shows its whole set.
BOUNDS = (1 << 62, 1 << 63)
#: What rounding may add to a product with the similarity.
SLACK = 1e-6
#: Classes and shingles in a chunk of a cluster, and columns of its incidence matrix that are multiplied at a time.
CHUNK = 1024
ELEMENTS = 1 << 20
COLUMNS = 512
#: Rows of a tile that are compared with the other side at a time.
STRIP = 128


def shown(kinds: np.ndarray, similarity: float) -> tuple[np.ndarray, int]:
    """The sorted shingles below the smallest bound that leaves enough, and the number of the bound."""
    needed = len(kinds) - math.ceil(similarity * len(kinds) - SLACK) + 1
    for level, bound in enumerate(BOUNDS):
        n = int(np.searchsorted(kinds, np.uint64(bound)))
        if n >= needed:
            return kinds[:n], level
    return kinds, len(BOUNDS)


def described(docs: DataFrame, width: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Shingle-set size and hash, and the shown shingles of every row."""
    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(2))
            data = raw.tobytes()
            size, sig, keys, levels, below = [], [], [], [], []
            for i in range(batch.num_rows):
                kinds = np.unique(simhash.shingle_hashes(data[at[i]:at[i + 1]], width))
                size.append(len(kinds))
                sig.append(xxhash.xxh64_intdigest(kinds.tobytes(), 1))
                few, level = shown(kinds, similarity)
                keys.append(few.view(np.int64))
                levels.append(level)
                below.append(np.searchsorted(few, np.array(BOUNDS, np.uint64)))
            low, half = np.array(below, np.int32).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int32()), pa.array(levels, pa.int32()), pa.array(low), pa.array(half),
                 pa.array(np.array(sig, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "size", "level", "below0", "below1", "sig", "keys"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        lean(run), "doc_id long, text_hash long, size int, level int, below0 int, below1 int, sig long, keys array<long>")


def blocks_of(classes: DataFrame, similarity: float) -> DataFrame:
    """Every shared shingle that could be a pair's first common one, with what bounds the overlap from there.

    ``before<k>`` counts the shown shingles of the class below bound k that come before, by how many classes
    show them; ``below<k>`` counts all of them.
    """
    each = classes.select("sig", F.explode("d.keys").alias("block"))
    several = each.groupBy(F.col("block").alias("met")).agg(F.count("*").alias("often")).filter("often > 1")
    shared = each.join(several, F.col("block") == F.col("met")).select("sig", "block", "often")
    about = classes.select(F.col("sig").alias("of_sig"), *[F.col(f"d.{c}").alias(c) for c in ("size", "level", "below0", "below1")])
    placed = shared.join(about, F.col("sig") == F.col("of_sig"))
    mine = Window.partitionBy("sig")
    upto = mine.orderBy("often", "block").rowsBetween(Window.unboundedPreceding, 0)
    inside = [(F.col("block") >= 0) & (F.col("block") < F.lit(BOUNDS[0])), F.col("block") >= 0, F.lit(True)]
    for k, (within, below) in enumerate(zip(inside, ("below0", "below1", "size"))):
        one = within.cast("int")  # unshared shingles come first
        placed = placed.withColumn(f"before{k}", F.when(within, F.col(below) - F.sum(one).over(mine) + F.sum(one).over(upto) - 1).cast("int"))
    first = F.coalesce("before0", "before1", "before2")
    placed = placed.filter(F.col("size") - first >= similarity * F.col("size") - SLACK)
    # The bits of a rung tell sizes apart: near copies are at most one rung from each other.
    rung = F.least(F.floor(F.log("size") / math.log(1 / similarity)), F.lit(62)).cast("int")
    fp = F.call_function("shiftleft", F.lit(1).cast("long"), rung) - 1
    never = F.lit(np.iinfo(np.int32).max)
    return placed.select("block", fp.alias("fp"), "sig", "level", "below0", "below1", "size", *[F.coalesce(f"before{k}", never).alias(f"before{k}") for k in range(3)],
                         F.col("block").alias("key"))


def forest(names: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``names[i] - names[j]`` thinned to at most one for each name, with the same components."""
    label = components(len(names), i, j)
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[label[moved]], names[moved]


def candidates(similarity: float):
    """A spanning forest of the pairs of a tile, or between two, that may be near copies."""
    share = similarity / (1 + similarity)

    def meets(a, other, low, high):
        """Candidates among rows ``[low, high)`` of one side and all of the other."""
        i, j = np.nonzero((a[-1][low:high, None] == other[-1][None, :]) & (a[1][low:high, None] != other[1][None, :]))
        i += low
        # Both show all they have below the smaller of their bounds.
        level = np.minimum(a[2][i], other[2][j])
        (ua, pa_), (ub, pb) = ((np.choose(level, [x[k][w] for k in (3, 4, 5)]), np.choose(level, [x[k][w] for k in (6, 7, 8)]))
                               for x, w in ((a, i), (other, j)))
        na, nb = a[5][i], other[5][j]
        good = np.minimum(ua - pa_, ub - pb) + np.minimum(na - ua, nb - ub) >= share * (na + nb) - SLACK
        return i[good], j[good]

    def compare(a, b):
        other = a if b is None else b
        names = a[1] if b is None else np.concatenate([a[1], b[1]])
        one, two = [], []
        # A strip at a time, so that no task holds all pairs of a tile.
        for low in range(0, len(a[1]), STRIP):
            i, j = meets(a, other, low, min(low + STRIP, len(a[1])))
            label = components(len(names), i, j if b is None else j + len(a[1]))
            moved = np.flatnonzero(label != np.arange(len(names)))
            one.append(label[moved])
            two.append(moved)
        return forest(names, np.concatenate(one), np.concatenate(two))

    return compare


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every pair of sets: the incidence matrix times itself.

    Elements of one set alone are left out; elements with the same holders are one weighted column.
    """
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(values, return_inverse=True, return_counts=True)
    several = held[column] > 1
    owner, column = owner[several], np.unique(column[several], return_inverse=True)[1]
    n = int(column.max()) + 1 if len(column) else 0
    holders = np.zeros(n, np.uint64)
    np.add.at(holders, column, mix(np.arange(1, len(sets) + 1, dtype=np.uint64)[owner] * np.uint64(0x9E3779B97F4A7C15)))
    _, first, kind, weight = np.unique(holders, return_index=True, return_inverse=True, return_counts=True)
    shown = first[kind[column]] == column
    owner, kind = owner[shown], kind[column[shown]]
    common = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers below 2 ** 24
    for low in range(0, len(weight), COLUMNS):
        inside = (kind >= low) & (kind < low + COLUMNS)
        here = np.zeros((len(sets), min(COLUMNS, len(weight) - low)), np.float32)
        here[owner[inside], kind[inside] - low] = 1
        common += (here * weight[low:low + COLUMNS].astype(np.float32)) @ here.T
    return common


def verified(tiles: DataFrame, similarity: float) -> DataFrame:
    """A spanning forest of the near copies in every tile: rows ``(tile, sig, grouped, shingles)``.

    Classes with equal ``grouped`` are in one group already.
    """
    def settle(held):
        names, groups = np.array([r[0] for r in held]), np.array([r[1] for r in held])
        sets = [r[2] for r in held]
        size = np.array([len(s) for s in sets])
        common = overlaps(sets)
        one, two = [], []
        for low in range(0, len(sets), STRIP):
            c = common[low:low + STRIP]
            near = c >= similarity * (size[low:low + STRIP, None] + size[None, :] - c.astype(np.float64)) - SLACK
            near &= groups[low:low + STRIP, None] != groups[None, :]
            i, j = np.nonzero(near)
            label = components(len(sets), i + low, j)
            moved = np.flatnonzero(label != np.arange(len(sets)))
            one.append(label[moved])
            two.append(moved)
        i, j = np.concatenate(one), np.concatenate(two)
        return forest(names, i, j)

    def run(batches):
        held, key = [], None
        for batch in batches:
            tile, sig, grouped = (batch.column(k).to_numpy() for k in range(3))
            flat = batch.column(3).flatten().to_numpy()
            ends = np.r_[0, np.cumsum(batch.column(3).value_lengths().to_numpy())]
            found = []
            for k in range(batch.num_rows):
                if tile[k] != key:
                    if len(held) > 1:
                        found.append(settle(held))
                    held, key = [], tile[k]
                held.append((sig[k], grouped[k], flat[ends[k]:ends[k + 1]]))
            yield simhash._edges(found)
        if len(held) > 1:
            yield simhash._edges([settle(held)])

    dealt = tiles.select("tile", "sig", "grouped", "shingles").repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(lean(run), "a long, b long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(sig, cluster, shingles)``: the sorted shingle hashes of one text of each wanted class."""
    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(2))
            data = raw.tobytes()
            sets = [np.unique(simhash.shingle_hashes(data[at[i]:at[i + 1]], width)).view(np.int64) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))],
                                             ["sig", "cluster", "shingles"])

    joined = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.in_doc) & (docs.text_hash == wanted.in_text))
    return joined.select("sig", "cluster", "text").mapInArrow(lean(run), "sig long, cluster long, shingles array<long>").dropDuplicates(["sig"])


def links(sets: DataFrame, similarity: float, chunk: int = CHUNK, elements: int = ELEMENTS) -> DataFrame:
    """Verified links ``(a, b)`` that connect all near copies of every cluster."""
    parts = lambda n, words: F.greatest(F.ceil(n / chunk), F.ceil(words / elements)).cast("int")
    sizes = sets.groupBy(F.col("cluster").alias("of_cluster")).agg(
        parts(F.count("*"), F.sum(F.size("shingles"))).alias("chunks")).filter("chunks > 1")
    dealt = sets.join(small(cut(sizes)), F.col("cluster") == F.col("of_cluster"), "left")
    dealt = dealt.withColumn("chunks", F.coalesce("chunks", F.lit(1))).drop("of_cluster")
    dealt = cut(dealt.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "sig"), F.col("chunks")).cast("int")))
    # Chunk 0 is in the tile of every other chunk.
    meets = F.when(F.col("chunk") == 0, F.sequence(F.least(F.lit(1), F.col("chunks") - 1), F.col("chunks") - 1)).otherwise(F.array("chunk"))
    first = dealt.select(F.explode(meets).alias("with"), "cluster", "sig", "shingles").select(
        F.xxhash64("cluster", "with").alias("tile"), "sig", F.col("sig").alias("grouped"), "shingles")
    found = cut(verified(first, similarity))
    wide = dealt.filter("chunks > 2")
    if not wide.head(1):
        return found
    roots = simhash.connect(found)
    named = wide.join(roots, wide.sig == roots.node, "left").withColumn("grouped", F.coalesce("root", "sig")).drop("node", "root")
    groups = cut(named.groupBy("cluster", "grouped").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("words")))
    top = groups.groupBy(F.col("cluster").alias("of_cluster")).agg(
        F.max_by("grouped", F.struct("n", "grouped")).alias("top"), F.sum("n").alias("n"), F.sum("words").alias("words"),
        F.max_by(F.struct("n", "words"), F.struct("n", "grouped")).alias("most"))
    rest = top.select("of_cluster", "top", parts(F.col("n") - F.col("most.n"), F.col("words") - F.col("most.words")).alias("others"))
    both = named.join(small(cut(rest.filter("others > 0"))), F.col("cluster") == F.col("of_cluster"))
    in_top = F.col("grouped") == F.col("top")
    other = F.pmod(F.xxhash64(F.lit(2), "sig"), F.col("others")).cast("int")
    # Tiles are pairs of a chunk of the largest group (numbered below 0) or of the others with a chunk of the others.
    across = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: F.struct((-1 - F.col("chunk")).alias("one"), k.alias("two")))
    own = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct((-1 - k).alias("one"), other.alias("two"))),
        F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: F.struct(F.least(k, other).alias("one"), F.greatest(k, other).alias("two"))))
    second = both.select(F.explode(F.when(in_top, across).otherwise(own)).alias("at"), "cluster", "sig", "grouped", "shingles").select(
        F.xxhash64("cluster", "at").alias("tile"), "sig", "grouped", "shingles")
    return found.unionByName(cut(verified(second, similarity)))


def one_of_each(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the rows that stay."""
    # The shown shingles are worked out again for the classes; kept beside every row they would be stored twice.
    about = described(docs, width, similarity, id_col, text_col)
    rows = cut(about.select("doc_id", "text_hash", "sig"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    classes = cut(about.groupBy("sig").agg(F.min(order).alias("first"), F.min(F.struct("size", "level", "below0", "below1", "keys")).alias("d")))
    tiles = cut(blocks_of(classes, similarity))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    clusters = simhash.connect(simhash.compared(tiles, 1, candidates(similarity)))
    members = clusters.select(F.col("node").alias("member"), F.col("root").alias("cluster"))
    members = members.unionByName(members.select(F.col("cluster").alias("member"), "cluster").distinct())
    wanted = classes.join(members, classes.sig == members.member).select(
        "sig", "cluster", F.col("first.doc_id").alias("in_doc"), F.col("first.text_hash").alias("in_text"))
    roots = simhash.connect(links(cut(shingle_sets(source, wanted, width)), similarity))

    named = classes.join(roots, classes.sig == roots.node, "left").select("sig", "first", F.coalesce("root", "sig").alias("group"))
    stay = named.groupBy(F.col("group").alias("of_group")).agg(F.min("first").alias("stays"))
    keeps = named.join(stay, named.group == stay.of_group).select(F.col("sig").alias("of_sig"), "stays")
    marked = cut(rows.select("sig", order.alias("me")).groupBy("sig", "me").agg(F.count("*").alias("n"))
                 .join(keeps, F.col("sig") == F.col("of_sig"))
                 .select("me", (F.col("me") != F.col("stays")).alias("gone"), "n").filter("gone or n > 1"))

    names = [f"c{i}" for i in range(len(docs.columns))]
    tagged = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("row"),
                         F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))

    def among(keys: DataFrame, how: str) -> DataFrame:
        keys = small(keys.select(F.col("me.doc_id").alias("in_doc"), F.col("me.text_hash").alias("in_text")))
        return tagged.join(keys, F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_hash") == F.col("in_text")), how)

    left_over = among(marked, "left_anti").select("row")
    repeats = marked.filter("not gone")
    if repeats.head(1):
        again = among(repeats, "left_semi").groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
        left_over = left_over.unionByName(again.select("row"))
    return left_over.select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)])
