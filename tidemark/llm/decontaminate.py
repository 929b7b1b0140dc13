"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is a fixed mask over word positions that reads five words and ignores those between, so a
hit survives a changed word at an ignored place.  Seeds of documents and benchmark items meet in
a hash join; every hit names a diagonal (document position minus item position), and diagonals
are verified word by word: contaminated means that some ``WINDOW`` consecutive words of the item
(all of a shorter item) agree with the document in at least ``SHARE`` of their places.

The words of the benchmark screen document positions before seeds are hashed, while there are at
most ``MOST_WORDS`` of them; seeds, items and candidates are broadcast only below counted bounds
and joined by shuffle beyond, with the same result.

Defined cases: words are lower-cased runs of letters and digits; null and wordless texts match
nothing; items of fewer than nine words are too short to be evidence and match nothing; repeated
documents or items each give their rows; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Word places a seed reads.  All read places 0 and 5, which screen the positions.
MASKS = ((0, 1, 3, 5, 6), (0, 2, 4, 5, 8), (0, 1, 5, 7, 8))
SCREEN = 5
SPAN = 9
WINDOW = 15
SHARE = 0.8
MOST_WORDS = 50_000
MOST_BROADCAST = 200_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; one empty word for a text without any."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def seed(hashes: Column, at: Column, number: int) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(hashes, at + place) for place in MASKS[number]])


def _seeds_at(starts: Column, number: int) -> Column:
    return F.transform(starts, lambda q: seed(F.col("h"), q, number))


def _known(word: Column, known: list[int]) -> Column:
    """The hash of a benchmark word, null for any other."""
    return F.when(word.isin(known), word)


def small(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """Mark a materialised table for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= most else df


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", share: float = SHARE,
             most_words: int = MOST_WORDS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``(doc_id, text_hash, item_id, start, matched, item_words)`` of contaminated documents.

    ``start`` is the document word where the item begins (negative if its head is missing),
    ``matched`` the words that agree on that diagonal; the best diagonal of each pair is given.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("item"))
    items = items.filter(F.size("item") >= SPAN)
    items = cut(items.select("item_id", "item", F.xxhash64("item_id", F.array_join("item", " ")).alias("item_key"))
                .dropDuplicates(["item_key"]))
    hashed = items.select("item_key", F.size("item").alias("item_words"),
                          F.transform("item", lambda w: F.xxhash64(w)).alias("h"))
    starts = F.sequence(F.lit(0), F.size("h") - SPAN)
    seeds = None
    for number in range(len(MASKS)):
        rows = hashed.select("item_key", "item_words", F.posexplode(_seeds_at(starts, number)).alias("q", "seed"))
        seeds = rows if seeds is None else seeds.unionByName(rows)
    seeds = small(cut(seeds), most_broadcast)

    words = hashed.select(F.explode("h").alias("w")).distinct().limit(most_words + 1).collect()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    h = F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w))
    if len(words) <= most_words:
        known = [r.w for r in words]
        h = F.transform(tokens(F.col("text")), lambda w: _known(F.xxhash64(w), known))
    placed = source.select("doc_id", "text_hash", h.alias("h"))
    placed = placed.withColumn("p", F.filter(
        F.sequence(F.lit(0), F.size("h") - 1),
        lambda i: F.get("h", i).isNotNull() & F.get("h", i + SCREEN).isNotNull()))
    each = F.transform("p", lambda i: F.struct(
        i.alias("p"), F.array(*[seed(F.col("h"), i, n) for n in range(len(MASKS))]).alias("seeds")))
    at = placed.select("doc_id", "text_hash", F.explode(each).alias("x"))
    at = at.select("doc_id", "text_hash", "x.p", F.explode("x.seeds").alias("found"))
    hits = at.join(seeds, F.col("found") == F.col("seed"))
    diagonals = hits.select("doc_id", "text_hash", "item_key", "item_words", (F.col("p") - F.col("q")).alias("start"))
    diagonals = diagonals.distinct()
    wanted = cut(diagonals.groupBy(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text"))
                 .agg(F.collect_list(F.struct("item_key", "item_words", "start")).alias("diagonals")))

    again = source.join(small(wanted, most_broadcast), F.col("doc_id").eqNullSafe(F.col("in_doc"))
                        & F.col("text_hash").eqNullSafe(F.col("in_text")))
    again = again.select("doc_id", "text_hash", tokens(F.col("text")).alias("w"), "diagonals")
    # Only the words next to an item leave the document's row.
    pieces = F.transform("diagonals", lambda d: F.struct(
        d.item_key.alias("for_item"), d.start.alias("start"),
        F.slice("w", F.greatest(d.start, F.lit(0)) + 1, d.item_words + F.least(d.start, F.lit(0))).alias("piece")))
    rows = again.select("doc_id", "text_hash", F.explode(pieces).alias("d")).select("doc_id", "text_hash", "d.*")
    rows = rows.join(small(items, most_broadcast // 10), F.col("for_item") == F.col("item_key"))
    agree = F.transform("item", lambda w, q: (w == F.get("piece", q + F.least(F.col("start"), F.lit(0)))))
    agree = F.transform(agree, lambda same: F.coalesce(same.cast("int"), F.lit(0)))
    width = F.least(F.size("item"), F.lit(WINDOW))
    best = F.array_max(F.transform(
        F.sequence(F.lit(0), F.size("agree") - F.col("width")),
        lambda s: F.aggregate(F.slice("agree", s + 1, F.col("width")), F.lit(0), lambda a, x: a + x)))
    checked = (rows.withColumn("agree", agree).withColumn("width", width).withColumn("best", best)
               .filter(F.col("best") >= F.ceil(F.col("width") * F.lit(share)))
               .withColumn("matched", F.aggregate("agree", F.lit(0), lambda a, x: a + x)))
    top = F.max_by(F.struct("start", "matched"), F.struct(F.col("matched"), -F.col("start"))).alias("top")
    return (checked.groupBy("doc_id", "text_hash", "item_key", "item_id").agg(top, F.max(F.size("item")).alias("item_words"))
            .select("doc_id", "text_hash", "item_id", "top.start", "top.matched", "item_words"))
