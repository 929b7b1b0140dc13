"""Sharding by best-fit-decreasing bin packing of indivisible groups of equal texts.

Groups are sorted by size, largest first, and each enters the shard whose remaining capacity is the
tightest that holds it; a balanced tree over remaining capacities finds that shard, and a new one
opens where none holds it.  Sizes are rounded up to ``BITS`` leading bits, so a corpus of any size
has a bounded number of size classes, and equal items enter their shards in runs: the plan is
made from counts alone.  A group's place in the plan is its rank among the groups of its class, in a
seeded order.

``pack`` needs as few shards of a fixed capacity as best fit decreasing finds; with ``shards``
the capacity is the smallest that needs no more, so sizes come out near equal.

A group larger than a shard cannot stay whole: it is cut into pieces that a shard holds (single
documents where one exceeds it), dealt in the seeded order of its documents.  Groups with more than a
thousandth of all rows are fewer than a thousand and are looked up by broadcast; all others meet
their documents in a join.  Ranks are running counts in two levels, over buckets and inside one, so
neither a class nor a shard nor a group is ever sorted in one task.

Defined cases: a null text has no bytes and is in one group with the empty ones; ties in size go by
the seeded order; repeated rows are separate documents of one group; an empty table gives no rows;
texts of any length are one item.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut

SEED = 20240311
#: Bytes a document takes besides its text.
OVERHEAD = 16
#: Leading bits of a size that are told apart; the rest rounds up.
BITS = 10
#: Rows numbered by one task.
BUCKET = 10_000
#: Groups with more than this share of the rows are looked up by broadcast.
LARGE = 1000


class Remaining:
    """Shards by remaining capacity: an AA tree of ``(room, shard)``."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _skew(t):
        if t and t[2] and t[2][0] == t[0]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[3] and t[3][3] and t[3][3][0] == t[0]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[0] += 1
            return right
        return t

    def add(self, key: tuple[int, int]) -> None:
        def put(t):
            if t is None:
                return [1, key, None, None]  # level, key, left, right
            side = 2 if key < t[1] else 3
            t[side] = put(t[side])
            return self._split(self._skew(t))

        self.root = put(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def drop(t, key):
            if t is None:
                return None
            if key < t[1]:
                t[2] = drop(t[2], key)
            elif key > t[1]:
                t[3] = drop(t[3], key)
            elif t[2] is None:
                return t[3]
            else:
                at = t[2]
                while at[3]:
                    at = at[3]
                t[1] = at[1]
                t[2] = drop(t[2], at[1])
            level = 1 + min(t[2][0] if t[2] else 0, t[3][0] if t[3] else 0)
            if level < t[0]:
                t[0] = level
                if t[3] and t[3][0] > level:
                    t[3][0] = level
            t = self._skew(t)
            t[3] = self._skew(t[3])
            if t[3]:
                t[3][3] = self._skew(t[3][3])
            t = self._split(t)
            t[3] = self._split(t[3])
            return t

        self.root = drop(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least room of at least ``size``; the first shard of those with equal room."""
        found, t = None, self.root
        while t:
            if t[1] >= (size, -1):
                found, t = t[1], t[2]
            else:
                t = t[3]
        return found


def best_fit(classes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """Runs ``(class size, first rank, end rank, shard)`` and the number of shards.

    ``classes`` are ``(size, count)``, largest first; an item beyond the capacity has a shard of its own.
    None once more than ``most`` shards open.
    """
    rooms, runs, shards = Remaining(), [], 0
    for size, count in classes:
        rank = 0
        while rank < count:
            best = rooms.tightest(size)
            if best is None:
                if shards == most:
                    return None
                best = (max(capacity, size), shards)
                shards += 1
            else:
                rooms.remove(best)
            room, shard = best
            n = min(count - rank, room // size)
            runs.append((size, rank, rank + n, shard))
            rank += n
            rooms.add((room - n * size, shard))
    return runs, shards


def fewest(classes: list[tuple[int, int]], shards: int):
    """The runs of the smallest capacity, found by bisection, that fills at most ``shards`` shards."""
    left, alone = sum(size * count for size, count in classes), 0
    for size in (size for size, count in classes for _ in range(min(count, shards))):
        if alone == shards - 1 or size * (shards - alone) <= left:
            break
        left, alone = left - size, alone + 1  # larger than its share: it fills a shard on its own
    low = high = -(-left // (shards - alone))
    while (plan := best_fit(classes, high, shards)) is None:
        low, high = high + 1, high + high // 4 + 1
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(classes, middle, shards)
        if tried is None:
            low = middle + 1
        else:
            high, plan = middle, tried
    return plan


def size_class(size):
    """``size`` rounded up to ``BITS`` leading bits."""
    drop = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0)).cast("int")
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), drop)
    return (F.floor((size + unit - 1) / unit) * unit).cast("long")


def numbered(df: DataFrame, key: list[str], order: list[str], name: str, rows: int = BUCKET) -> DataFrame:
    """``df`` with its rank from 0 within ``key``, by ``draw`` and then ``order``.

    ``df`` is read three times, so it should be materialised; ``draw`` is a hash that spreads its rows.
    """
    held = df.groupBy(*key).agg(F.ceil(F.count("*") / rows).alias("_buckets"))
    held = held.withColumnsRenamed({k: f"_of_{k}" for k in key})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key]
    share = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    # Every caller numbers few keys: size classes, shards or groups that are looked up by broadcast.
    dealt = df.join(F.broadcast(held), same).withColumn("_bucket", F.floor(share * F.col("_buckets"))).drop(*held.columns)
    sums = dealt.groupBy(*key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    sums = sums.withColumnsRenamed({k: f"_of_{k}" for k in [*key, "_bucket"]})
    inside = Window.partitionBy(*key, "_bucket").orderBy(F.shiftrightunsigned("draw", 11), "draw", *order)
    ranked = dealt.join(sums, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*key, "_bucket"]])
    ranked = ranked.withColumn(name, (F.col("_base") + F.row_number().over(inside) - 1).cast("long"))
    return ranked.drop("_bucket", "_base", *[f"_of_{k}" for k in [*key, "_bucket"]])


def rows_of(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """Id, size, checksum, group and a seeded draw of every document; equal rows differ in ``copy``."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"))
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("times"))
    # Copies of one row are made in chunks that are dealt out first.
    chunks = F.sequence(F.lit(0), F.floor((F.col("times") - 1) / BUCKET))
    dealt = counted.withColumn("chunk", F.explode(chunks)).repartition("doc_id", "group", "chunk")
    last = F.least(F.col("times"), (F.col("chunk") + 1) * BUCKET) - 1
    copies = dealt.withColumn("copy", F.explode(F.sequence(F.col("chunk") * BUCKET, last)))
    return copies.select(*rows.columns, "copy", F.xxhash64(F.lit(seed), "doc_id", "group", "copy").alias("draw"))


def pack(docs: DataFrame, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id",
         text_col: str = "text", seed: int = SEED, bucket: int = BUCKET, large: int = LARGE) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every document.

    Give ``capacity`` for as few shards as fit, or ``shards`` for that many of near equal size.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give the number of shards or their capacity")
    rows = cut(rows_of(docs, id_col, text_col, seed))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    most = capacity or -(-total.bytes // shards) or 1

    per = F.when(F.col("n") * F.col("size") > most, F.greatest(F.lit(1), F.floor(F.lit(most) / F.col("size")))).otherwise(F.col("n"))
    groups = cut(rows.groupBy("group").agg(F.count("*").alias("n"), F.first("size").alias("size"))
                 .withColumn("per", per).withColumn("pieces", F.ceil(F.col("n") / F.col("per"))))
    items = groups.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    held = F.least(F.col("per"), F.col("n") - F.col("piece") * F.col("per"))
    items = cut(items.select("group", "piece", size_class(held * F.col("size")).alias("class"),
                             F.xxhash64(F.lit(seed), "group", "piece").alias("draw")))
    # At most 2 ** (BITS - 1) classes for each doubling of the size, with their counts.
    classes = [tuple(r) for r in items.groupBy("class").count().orderBy(F.desc("class")).collect()]
    plan = ([], 0) if not classes else best_fit(classes, capacity) if capacity else fewest(classes, shards)
    runs: dict = {}
    for size, start, stop, shard in plan[0]:
        runs.setdefault(size, []).append((start, stop, shard))
    table = docs.sparkSession.createDataFrame(
        [(size, r) for size, r in runs.items()], "for_class long, runs array<struct<start:long,stop:long,shard:int>>")
    ranked = numbered(items, ["class"], ["group", "piece"], "rank", bucket)
    ranked = ranked.join(F.broadcast(table), F.col("class") == F.col("for_class"))  # one row for a class
    shard = F.filter("runs", lambda r: (r.start <= F.col("rank")) & (F.col("rank") < r.stop))[0].shard
    placed = cut(ranked.select(F.col("group").alias("of_group"), "piece", shard.alias("shard")))

    hot = groups.filter((F.col("n") * large > total.n) | (F.col("pieces") > 1)).select(F.col("group").alias("hot"), "per")
    hot = F.broadcast(cut(hot))  # fewer than `large` groups, and those that fill a shard on their own
    usual = rows.join(hot, F.col("group") == F.col("hot"), "left_anti").join(placed, F.col("group") == F.col("of_group"))
    many = cut(rows.join(hot, F.col("group") == F.col("hot")).drop("hot"))
    spread = numbered(many, ["group"], ["doc_id", "copy"], "at", bucket).withColumn("in_piece", F.floor(F.col("at") / F.col("per")))
    pieces = F.broadcast(placed.join(hot, F.col("of_group") == F.col("hot"), "left_semi"))
    spread = spread.join(pieces, (F.col("group") == F.col("of_group")) & (F.col("in_piece") == F.col("piece")))
    columns = ["doc_id", "size", "text_crc32", "group", "copy", "draw", "shard"]
    dealt = cut(usual.select(*columns).unionByName(spread.select(*columns)))
    return numbered(dealt, ["shard"], ["doc_id", "group", "copy"], "slot", bucket).select(
        "doc_id", "size", "text_crc32", "shard", "slot")
