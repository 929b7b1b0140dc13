"""Best-fit shards, Ptolemaic clusters and pivotal grams against plain forms of the same rules."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from tidemark.llm import centroids, sharding, spelling
from tidemark.llm.queries import ORACLE, QUERIES
from llm_tables import awkward, awkward_rows, awkward_vectors, empty  # noqa: F401

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ shards

def plain_best_fit(items, capacity):
    """Every item into the shard of least room that holds it, shards searched one by one."""
    rooms, placed = [], []
    for size in items:
        fits = [k for k, room in enumerate(rooms) if room >= size]
        if fits:
            k = min(fits, key=lambda k: (rooms[k], k))
        else:
            k = len(rooms)
            rooms.append(max(capacity, size))
        rooms[k] -= size
        placed.append(k)
    return placed, len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_runs_place_items_as_one_by_one(seed):
    chance = random.Random(seed)
    sizes = sorted((chance.choice([5, 7, 50, 61, 99, 130, chance.randrange(1, 200)]) for _ in range(chance.randrange(1, 150))), reverse=True)
    capacity = chance.randrange(60, 400)
    runs, shards = sharding.best_fit(sorted(Counter(sizes).items(), reverse=True), capacity)
    placed, want = plain_best_fit(sizes, capacity)
    got = [shard for size, a, b, shard in runs for _ in range(a, b)]
    assert shards == want and got == placed


def test_tree_finds_the_tightest_room():
    chance = random.Random(1)
    tree, plain = sharding.Remaining(), set()
    for k in range(3000):
        if plain and chance.random() < 0.45:
            key = chance.choice(sorted(plain))
            plain.remove(key)
            tree.remove(key)
        else:
            key = (chance.randrange(500), k)
            plain.add(key)
            tree.add(key)
        size = chance.randrange(500)
        assert tree.tightest(size) == min((x for x in plain if x[0] >= size), default=None)

    def depth(t):
        return 0 if t is None else 1 + max(depth(t[2]), depth(t[3]))

    assert depth(tree.root) <= 2 * np.log2(len(plain) + 1) + 1


def test_the_smallest_capacity_is_found():
    classes = [(90, 4), (40, 10), (7, 100), (1, 300)]
    runs, shards = sharding.fewest(classes, 8)
    loads = Counter()
    for size, a, b, shard in runs:
        loads[shard] += size * (b - a)
    assert shards == 8 and max(loads.values()) - min(loads.values()) <= 7 and sum(b - a for _, a, b, _ in runs) == 414
    assert sharding.fewest([(1000, 1), (1, 70)], 8)[1] == 8  # one item beyond its share leaves the others even


def whole(rows, groups_cut=()):
    by_group, slots = {}, {}
    for r in rows:
        by_group.setdefault(r.text_crc32, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {g for g, shards in by_group.items() if len(shards) > 1} == set(groups_cut)
    return by_group


def test_op11_on_whole_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 40
    whole(rows)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert len(loads) == 40 and max(loads.values()) < 1.01 * min(loads.values())
    assert sorted(rows) == sorted(QUERIES["op11_sharding"](spark, SF).collect())


def test_ranks_and_pieces_do_not_depend_on_buckets(spark):
    """A group of a third of all rows that no shard holds is cut; buckets of three rows number as one would."""
    chance = random.Random(2)
    texts = ["hot " * 20] * 100 + ["", None] * 20 + ["x" * chance.randrange(1, 200) + str(k) for k in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(5, texts[5])] * 9, "doc_id long, text string").repartition(5)
    a, b = (sharding.pack(df, shards=8, bucket=n, large=m).collect() for n, m in ((3, 1000), (10_000, 2)))
    assert sorted(a) == sorted(b) and len(a) == len(texts) + 9
    hot = zlib.crc32(texts[0].encode())
    by_group = whole(a, [hot])
    assert len(by_group[hot]) >= 2
    loads = Counter()
    for r in a:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.1 * sum(loads.values()) / 8
    fixed = sharding.pack(df, capacity=3000, bucket=50).collect()
    full = Counter()
    for r in fixed:
        full[r.shard] += r.size
    assert max(full.values()) <= 3000 and len(full) <= -(-sum(full.values()) // 3000) + 1


def test_op11_awkward_tables(spark, awkward, empty):
    rows = QUERIES["op11_sharding"](spark, awkward).collect()
    want = Counter((i, len((t or "").encode()) + 16) for i, t, *_ in awkward_rows())
    assert Counter((r.doc_id, r.size) for r in rows) == want
    whole(rows)
    assert QUERIES["op11_sharding"](spark, empty).collect() == []


# ------------------------------------------------------------------ clusters

def plain_clusters(vectors, clusters=16, rounds=3):
    """Whole numbers of Python throughout."""
    points = []
    for i, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            points.append((i, [int(np.floor(float(np.float32(x)) * 64)) for x in v]))
    order = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest(), p[1]))
    centres = [list(p) for _, p in order[:clusters]]
    far = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c))
    nearest = lambda p: min(range(len(centres)), key=lambda k: (far(p, centres[k]), k))
    for _ in range(rounds):
        members = {}
        for _, p in points:
            members.setdefault(nearest(p), []).append(p)
        for k, ps in members.items():
            centres[k] = [sum(c) // len(ps) for c in zip(*ps)]
    out = [(i, nearest(p), far(p, centres[nearest(p)])) for i, p in points]
    inertia = Counter()
    for _, k, d in out:
        inertia[k] += d
    return Counter((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest())
                   for i, k, d in out)


def test_op12_awkward_vectors(spark, awkward, empty):
    got = QUERIES["op12_centroid_clusters"](spark, awkward)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_clusters(awkward_vectors())
    none = QUERIES["op12_centroid_clusters"](spark, empty)
    assert none.collect() == [] and none.dtypes == got.dtypes


def test_op12_matches_duckdb(spark):
    assert compare(QUERIES["op12_centroid_clusters"](spark, SF), connect(SF), ORACLE["op12_centroid_clusters"]) is None


@pytest.mark.parametrize("seed, spreads", [(0, 3), (1, 40), (2, 2_000_000), (3, 0)])
def test_bounds_never_exceed_distances_and_ties_go_to_the_smaller_number(seed, spreads):
    chance = np.random.default_rng(seed)
    points = chance.integers(-spreads, spreads + 1, (500, 64))
    centres = np.concatenate([points[:12], points[3:6], points[:1]])       # repeated centroids tie
    pivots = centroids.spread(centres, 6)
    own = centroids.to_pivots(points, pivots)
    exact = ((points[:, None, :].astype(object) - centres[None, :, :].astype(object)) ** 2).sum(axis=2).astype(np.int64)
    bound = centroids.lower_bounds(own, centroids.to_pivots(centres, pivots), pivots)
    assert (bound * bound <= exact * (1 + 1e-15) + 1e-9).all()
    cluster, distance, examined = centroids.nearest(points, own, centres, pivots)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert examined <= len(points) * (len(centres) + 1)


def test_bounds_pass_over_far_centroids():
    chance = np.random.default_rng(5)
    centres = chance.integers(-500, 500, (16, 64))
    points = centres[chance.integers(0, 16, 4000)] + chance.integers(-9, 10, (4000, 64))
    pivots = centroids.spread(centres, 6)
    examined = centroids.nearest(points, centroids.to_pivots(points, pivots), centres, pivots)[2]
    assert examined < 4000 * 6  # of 16


def test_components_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(df).collect()


# ------------------------------------------------------------------ spelling

def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(docs, least=7, slip=31, ratio=10):
    import re
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    near = {w: [o for o in words if plain_near(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= ratio * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def rows_of(df):
    return {tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect()}


def test_op13_awkward_documents(spark, awkward, empty):
    assert rows_of(QUERIES["op13_spelling_variants"](spark, awkward)) == plain_variants([(r[0], r[1]) for r in awkward_rows()])
    assert QUERIES["op13_spelling_variants"](spark, empty).count() == 0


def test_op13_matches_duckdb(spark):
    assert compare(QUERIES["op13_spelling_variants"](spark, SF), connect(SF), ORACLE["op13_spelling_variants"]) is None


@pytest.mark.parametrize("seed, letters, length, large", [(1, "ab", 8, 200_000), (2, "ab", 8, 40), (3, "aéÿZ", 7, 10), (4, "abcdefgh", 30, 5), (5, "a", 40, 3)])
def test_near_words_of_small_alphabets(spark, seed, letters, length, large):
    """Repeated bigrams, ties of every kind and blocks far above the bound; slips in every third run."""
    chance = random.Random(seed)
    base = ["".join(chance.choice(letters) for _ in range(chance.randrange(6, length + 1))) for _ in range(60)]
    docs = [(None, None), (1, ""), (None, "aaaaaaa aaaaaaa aaaaaaab")]
    for k in range(150):
        w = list(chance.choice(base))
        at = chance.randrange(len(w))
        w[at:at + chance.randrange(2)] = [chance.choice(letters)] * chance.randrange(2)
        docs.append((k % 40, " ".join(["".join(w)] * chance.choice([1, 2, 30]) + [chance.choice(base)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(spelling.variants(df, large=large, slip=3)) == plain_variants(docs, slip=3)


def test_words_shorter_than_a_prefix_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([(1, "a")], "doc_id long, text string"), least_letters=3)


def test_pivots_do_not_overlap_and_are_the_cheapest():
    words = ["banana", "abcdefg", "aaaaaaa", "xyxyxyxy"]
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    at = np.r_[0, np.cumsum([len(w) for w in words])]
    often = np.arange(1 << 16)[::-1].copy()
    (w, g, p), (pw, pg, pp) = spelling.pivotal(raw, at, often)
    for k, word in enumerate(words):
        grams = sorted((often[ord(word[i]) << 8 | ord(word[i + 1])], ord(word[i]) << 8 | ord(word[i + 1]), i) for i in range(len(word) - 1))
        prefix = [x for x in grams if x[:2] <= grams[2][:2]]
        assert sorted(zip(g[w == k], p[w == k])) == sorted(x[1:] for x in prefix)
        spots = sorted(pp[pw == k])
        assert spots[1] - spots[0] >= 2
        cheapest = min(a[0] + b[0] for a in grams[:3] for b in grams[:3] if b[2] - a[2] >= 2)
        assert sum(often[x] for x in pg[pw == k]) == cheapest


def test_entries_of_a_word_do_not_grow_with_its_length(spark):
    """A bigram that recurs a thousand times gives a bounded number of entries, each of which carries the word."""
    long = ["a" * 3000, "a" * 3001, "ab" * 1500, "ab" * 1500 + "a", "ab" * 700 + "b" + "ab" * 800]
    docs = [(1, " ".join(long)), (2, " ".join(long)), (3, " ".join(long[:1] * 30 + long[2:3] * 30))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    words = spelling.vocabulary(df).select(F.encode("word", "ISO-8859-1").alias("word"), "n")
    assert spelling.entries(words, spelling.frequencies(words)).count() <= 20 * 5
    assert rows_of(spelling.variants(df, slip=31)) == plain_variants(docs)


def test_longest_words_are_near_each_other(spark):
    """Words of eight million letters, beyond what a place and a length once were given."""
    long = "q" + "abcdefgh" * (1 << 20)
    other = long[:5_000_000] + long[5_000_001:]
    df = spark.createDataFrame([(1,)], "doc_id long").select(
        "doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(
        "doc_id", F.concat(F.lit("q"), F.repeat(F.lit("abcdefgh"), 1 << 20)).alias("a"), F.lit(" ").alias("s"))
    df = df.select("doc_id", F.concat("a", "s", F.substring("a", 1, 5_000_000), F.expr("substring(a, 5000002)")).alias("text"))
    got = spelling.variants(df, slip=1 << 40).select(F.md5("word").alias("word"), F.length("word").alias("size"), "n", "n_near", "form").collect()
    md5 = lambda w: hashlib.md5(w.encode()).hexdigest()
    assert {tuple(r) for r in got} == {(md5(w), len(w), 2, 1, None) for w in (long, other)}


def test_many_variants_of_a_long_word(spark):
    """Blocks are dealt by their letters, too, and pairs are verified a bounded number of letters at a time."""
    chance = random.Random(4)
    base = "".join(chance.choice("abcdefghijklm") for _ in range(2000))
    docs = [(0, " ".join([base] * 30))]
    for k in range(120):
        at = chance.randrange(len(base))
        docs.append((k, " ".join([base[:at] + chance.choice(["", "z", "zz"]) + base[at + 1:]] * 2)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert rows_of(spelling.variants(df, large=500)) == plain_variants(docs)
