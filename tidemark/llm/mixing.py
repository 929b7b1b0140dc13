"""Mixing overlapping sources to target weights by minimum-cost flow, then seeded selection.

Documents are aggregated by membership pattern (the set of sources that hold them).  Word
capacity flows from patterns to source quotas; the k-th repetition of a pattern's words costs
k - 1 a word, so costs are convex and nothing is repeated while fresh words can serve.  Each
pattern's share of the flow is then spent on whole documents in a seeded order.

Only the pattern table reaches the driver, and only while it has at most ``max_patterns`` rows.
The seeded order is a running sum in two levels: over hash buckets, then inside a bucket, so a
source with most of the rows is spread over as many tasks as any other.

Defined cases: a null text or a text without words has size 0 and is never taken; a null source
is a source of its own and comes last; repeated rows are separate documents; an empty table
gives no rows.  Columns of the input other than those given are not read.
"""

from __future__ import annotations

import json
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, cut

SEED = 20240229
WEIGHTS = (5, 2, 1)
FACTOR = 1.5
MOST_REPEATS = 2
MOST_PATTERNS = 10_000
ROWS_PER_BUCKET = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight; what a source cannot take (``most`` times its size) is shared again."""
    target, open_ = {}, set(sizes)
    left = float(total)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if unit * weights[s] > most * sizes[s]]
        if not full:
            target.update({s: unit * weights[s] for s in open_})
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


def route(capacity: list[int], members: list[list], quota: dict, repeats: int) -> list[dict]:
    """Minimum-cost flow of words from patterns to sources; one ``{source: words}`` per pattern.

    Only repetitions cost anything, so cheapest paths first means: exhaust the first copies of all
    patterns by augmenting paths, then the second copies, and so on.
    """
    flow: list[dict] = [{s: 0 for s in m} for m in members]
    used = [0] * len(capacity)
    room = dict(quota)
    holders: dict = {}
    for p, m in enumerate(members):
        for s in m:
            holders.setdefault(s, []).append(p)
    for level in range(1, repeats + 1):
        for start in range(len(capacity)):
            while used[start] < capacity[start] * level:
                # Breadth first from the pattern over open arcs and reversed flows to a source with room.
                came: dict = {("p", start): None}
                queue, goal = deque([("p", start)]), None
                while queue and goal is None:
                    kind, x = queue.popleft()
                    nexts = [("s", s) for s in flow[x]] if kind == "p" else [("p", p) for p in holders[x] if flow[p][x]]
                    for n in nexts:
                        if n not in came:
                            came[n] = (kind, x)
                            if n[0] == "s" and room.get(n[1], 0) > 0:
                                goal = n
                                break
                            queue.append(n)
                if goal is None:
                    break
                path, at = [goal], came[goal]
                while at is not None:
                    path.append(at)
                    at = came[at]
                path.reverse()
                amount = min(capacity[start] * level - used[start], room[goal[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "s":
                        amount = min(amount, flow[b[1]][a[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                used[start] += amount
                room[goal[1]] -= amount
    return flow


def mix(docs: DataFrame, sources: Column, size: Column, order: Column, keep: list[str], weights=WEIGHTS,
        factor: float = FACTOR, repeats: int = MOST_REPEATS, max_patterns: int = MOST_PATTERNS,
        rows_per_bucket: int = ROWS_PER_BUCKET, wide: bool = False) -> DataFrame:
    """``keep`` columns plus ``size``, ``members``, ``taken`` and ``shares`` (words for each source).

    With ``wide`` the kept columns are read again from ``docs`` for the last step and not stored in between.

    ``sources`` is an array column, ``order`` a seeded hash that settles which documents go first.
    Weights repeat over the sources in code-point order, null last.
    """
    rows = docs.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("kept"), F.array_distinct(sources).alias("members"),
                       size.alias("size"), order.alias("draw"))
    rows = rows.withColumn("pattern", F.to_json(F.array_sort("members"))).drop("members")
    narrow = cut(rows.drop("kept") if wide else rows)
    rows = rows if wide else narrow
    patterns = (narrow.groupBy("pattern").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
                .limit(max_patterns + 1).collect())
    if len(patterns) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = sorted(patterns, key=lambda r: r.pattern)
    members = [json.loads(r.pattern) for r in patterns]
    sizes: dict = {}
    for r, m in zip(patterns, members):
        for s in m:
            sizes[s] = sizes.get(s, 0) + r.words
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    target = water_fill(sizes, weight, factor * sum(r.words for r in patterns), repeats)
    flow = route([r.words for r in patterns], members, {s: round(t) for s, t in target.items()}, repeats)

    # Words of a pattern lie on a line, copy after copy; each source owns a stretch of it.
    table = []
    for r, m, f in zip(patterns, members, flow):
        at, stretches = 0, []
        for s in sorted(f, key=lambda s: (s is None, s or "")):
            stretches.append({"source": s, "start": at, "stop": at + f[s]})
            at += f[s]
        table.append({"for_pattern": r.pattern, "capacity": r.words, "flow": at, "buckets": max(1, -(-r.n // rows_per_bucket)),
                      "stretches": stretches, "goals": [{"source": s, "words": sizes[s], "target": float(target[s])} for s in m]})
    stretch = pa.struct([("source", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    goal = pa.struct([("source", pa.string()), ("words", pa.int64()), ("target", pa.float64())])
    schema = pa.schema([("for_pattern", pa.string()), ("capacity", pa.int64()), ("flow", pa.int64()), ("buckets", pa.int64()),
                        ("stretches", pa.list_(stretch)), ("goals", pa.list_(goal))])
    # At most max_patterns rows.  An Arrow table becomes part of the plan; a list would start Python workers to be read.
    plan = F.broadcast(docs.sparkSession.createDataFrame(pa.Table.from_pylist(table, schema)))
    def in_buckets(some: DataFrame) -> DataFrame:
        return some.join(plan, some.pattern == F.col("for_pattern")).withColumn("bucket", F.pmod(F.xxhash64("draw"), F.col("buckets")))

    dealt = in_buckets(rows)
    sums = in_buckets(narrow).groupBy("pattern", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("pattern").alias("of_pattern"), F.col("bucket").alias("of_bucket"),
                       F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (dealt.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(sums, (F.col("pattern") == F.col("of_pattern")) & (F.col("bucket") == F.col("of_bucket"))))
    # A copy is taken if its middle lies before the end of the pattern's flow.
    middle = F.col("base") + F.col("within") + F.col("size") / 2
    copies = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda k: k * F.col("capacity") + middle)
    placed = placed.withColumn("at", F.filter(copies, lambda x: (x < F.col("flow")) & (F.col("size") > 0)))
    shares = F.transform("stretches", lambda s: F.struct(
        s.source.alias("source"),
        (F.size(F.filter("at", lambda x: (x >= s.start) & (x < s.stop))) * F.col("size")).alias("words")))
    return placed.select("kept.*", "size", (F.size("at") * F.col("size")).cast("long").alias("taken"), "goals",
                         shares.alias("shares"))


ADDED = ("size", "source_size", "target", "taken")


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
             **settings) -> DataFrame:
    """Every row with all its columns and the mix's ``ADDED`` ones, which replace columns of those names."""
    text, names = F.col(text_col).cast("string"), [c for c in docs.columns if c not in ADDED]
    mixed = mix(docs, F.array(F.col(source_col).cast("string")), word_count(text), F.xxhash64(F.lit(seed), id_col, text), names,
                wide=True, **settings)
    own = [F.col(f"`{c}`") for c in names]
    return mixed.select(*own, F.col("goals")[0].words.alias("source_size"), F.col("goals")[0].target.alias("target"), "size", "taken")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  seed: int = SEED, **settings) -> DataFrame:
    """The mix of a table in which every document names one source.

    Returns ``doc_id, source, size, source_size, target, taken``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).cast("string").alias("text"))
    mixed = mix(rows, F.array("source"), word_count(F.col("text")),
                F.xxhash64(F.lit(seed), "doc_id", "text"), ["doc_id", "source"], **settings)
    return mixed.select("doc_id", "source", "size", F.col("goals")[0].words.alias("source_size"),
                        F.col("goals")[0].target.alias("target"), "taken")
