"""All queries on awkward and empty tables, DuckDB equivalents, and held-out accuracy."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from tidemark.llm import chat, common, mixing, nearcopies, quality, secretscan, simhash, suffix_array, suffix_tree, windows
from tidemark.llm.queries import ORACLE, QUERIES
from llm_tables import awkward, awkward_rows, empty, words  # noqa: F401

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PER_ROW = ["op1_language_id", "op3_substring_dedup", "op5_suffix_array_dedup", "op6_simhash_near_dedup", "op7_quality_rules",
           "op9_mix_sources", "op10_toxicity", "op11_sharding"]


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_awkward_and_empty_tables(spark, awkward, empty, name):
    query = QUERIES.get(name, corpus_pipeline.run)
    rows = query(spark, awkward).collect()
    if name in PER_ROW:
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in awkward_rows())
    else:
        assert rows
    assert query(spark, empty).count() == 0


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_duckdb(spark, name):
    diff = compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name])
    assert diff is None, diff


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


# ------------------------------------------------------------------ repeated windows

def removed(sequences, width):
    """Flags of symbols covered by windows that start more than once, by counting all windows."""
    seen = Counter(s[i:i + width] for s in sequences for i in range(len(s) - width + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if seen[s[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


def test_op3_against_counting(spark):
    docs = texts_of(spark, SF)
    ids = sorted(docs)
    lists = [tuple(WORD.findall(docs[i] or "")) for i in ids]
    got = {r.doc_id: r for r in QUERIES["op3_substring_dedup"](spark, SF).collect()}
    for i, w, gone in zip(ids, lists, removed(lists, 35)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert tuple(got[i]) == (i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_op5_against_counting(spark):
    docs = texts_of(spark, SMALL)
    ids = sorted(docs)
    raw = [(docs[i] or "").encode() for i in ids]
    got = {r.doc_id: r for r in QUERIES["op5_suffix_array_dedup"](spark, SMALL).collect()}
    for i, text, gone in zip(ids, raw, removed(raw, 400)):
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(text, gone) if not g)
        assert tuple(got[i]) == (i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(3))
def test_small_shards_and_alphabets(spark, seed):
    """With bounds of a few bytes most anchors are split, so most windows are merged across shards."""
    chance = random.Random(seed)
    texts = ["".join(chance.choice("ab") for _ in range(chance.randrange(60))) for _ in range(40)]
    texts += [None, "", "a" * 90, "ab" * 40, texts[0], texts[1] + texts[2]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_array.dedup(df, length=8, gram=2, shard=40, hot=60).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (text, gone) in enumerate(zip(raw, removed(raw, 8))):
        assert got[i].kept == bytes(x for x, g in zip(text, gone) if not g), (i, text)
    spaced = [None if t is None else " ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(spaced)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_tree.dedup(df, window=6, gram=2, shard=40, hot=60).collect()}
    lists = [tuple((t or "").split()) for t in spaced]
    for i, (text, gone) in enumerate(zip(lists, removed(lists, 6))):
        assert got[i].kept == " ".join(x for x, g in zip(text, gone) if not g), (i, text)


@pytest.mark.parametrize("seed", range(20))
def test_suffix_array_and_prefixes(seed):
    chance = np.random.default_rng(seed)
    text = chance.integers(1, 3, chance.integers(1, 300)).astype(np.uint16)
    order = suffix_array.refine(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    common = suffix_array.kasai(text, order, np.array([0, len(text) // 2]), np.array([len(text) // 2, len(text) - len(text) // 2]), 50)
    for a, b in zip(order, order[1:]):
        n = 0
        while n < 50 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert common[b] == n


@pytest.mark.parametrize("most", [1, 2, 5, 1000])
def test_subtrees_do_not_depend_on_group_size(most):
    chance = np.random.default_rng(most)
    ids = chance.integers(0, 2, 500).astype(np.uint64)
    spec = windows.Spec(words=True, width=7, gram=2)
    sym = windows.Symbols(ids, np.array([0, 200, 203, 500]), np.zeros(0, np.uint8))
    flags = suffix_tree.repeated_starts(spec, sym, np.array([1, 2, 1]), most)
    parts = [tuple(ids[0:200]), tuple(ids[203:500])]
    seen = Counter(p[i:i + 7] for p in parts for i in range(len(p) - 6))
    expected = np.zeros(500, bool)
    for base, p in ((0, parts[0]), (203, parts[1])):
        for i in range(len(p) - 6):
            expected[base + i] = seen[p[i:i + 7]] > 1
    assert (flags == expected).all()


# ------------------------------------------------------------------ fingerprints

def plain_fingerprint(text, width):
    ws = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i:i + width]).encode(), 42) for i in range(max(1, len(ws) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(values, near):
    todo, out = set(values), {}
    while todo:
        root = min(todo)
        group, edge = {root}, [root]
        while edge:
            x = edge.pop()
            for y in [y for y in todo if y not in group and near(x, y)]:
                group.add(y)
                edge.append(y)
        for x in group:
            out[x] = root
        todo -= group
    return out


def test_op6_against_all_pairs(spark):
    docs = texts_of(spark, SMALL)
    prints = {i: plain_fingerprint(t, 3) for i, t in docs.items()}
    roots = smallest_reachable(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for r in QUERIES["op6_simhash_near_dedup"](spark, SMALL).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", roots[r.doc_id])


def test_large_blocks_lose_no_link(spark):
    """Blocks above the bound go through tile pairs; the components stay the same."""
    chance = random.Random(4)
    base = chance.getrandbits(64)
    values = {base}
    while len(values) < 300:
        x = chance.choice(sorted(values))
        values.add(x ^ (1 << chance.randrange(64)) ^ (1 << chance.randrange(64)))
    values |= {chance.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in simhash.connect(simhash.links(fps, 3, large=10)).collect()}
    want = smallest_reachable(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {v: got.get(v, v) for v in signed} == want


def test_connect_follows_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.connect(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


# ------------------------------------------------------------------ models

def test_op1_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op1_language_id"](spark, SF).collect() if r.held_out and lang[r.doc_id]]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97


def test_op10_held_out_accuracy(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_toxicity"](spark, SF).collect() if r.held_out and r.doc_id in toxic]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in rows]) > 0.9


def test_pair_of_terms_means_what_neither_does():
    from tidemark.llm import toxicity
    chance = np.random.default_rng(0)
    rows, features, labels = [], [], []
    for i in range(600):
        have = [f for f in (0, 1) if chance.random() < 0.5]
        rows += [i] * len(have)
        features += have
        labels.append(float(len(have) == 2))
    machine = toxicity.train(np.array(rows), np.array(features), np.array(labels), 2, np.arange(2))
    one, two, both = machine.raw_scores(np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1]), 3)
    assert both > 0 > max(one, two)


def test_op4_finds_assigned_and_published_formats(spark):
    docs = texts_of(spark, SF)
    found = QUERIES["op4_secret_scans"](spark, SF).filter("secret").collect()
    got = {(r.doc_id, r.start) for r in found}
    planted = re.compile(r'AKIA[A-Z2-7]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = ")[0-9a-f]{40}')
    want = {(i, m.start()) for i, t in docs.items() for m in planted.finditer(t or "")}
    assert want and len(want - got) <= len(want) // 20
    assert len(got - want) <= len(want) // 20


def test_labelled_findings_train_the_forest(spark):
    docs = [(i, f"path a{i} key {'%030x' % (i * 7919 ** 6)} tail" if i % 2 else f"path b{i} build-2024.{i:04d}.release tail")
            for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(i, docs[i][1].index("key") + 4 if i % 2 else docs[i][1].index("build"), i % 2)
                                   for i in range(40)], "doc_id long, start int, label int")
    scanner = secretscan.fit(df, findings=marks)
    rows = secretscan.scan(df, scanner, [F.col("doc_id")]).collect()
    assert {r.doc_id for r in rows if r.secret} == {i for i in range(60) if i % 2}
    masked = {r.doc_id: r.text for r in secretscan.redact(df, scanner).collect()}
    assert all((secretscan.MASK in masked[i]) == bool(i % 2) for i in range(60))


# ------------------------------------------------------------------ quality, mixing, chat

def test_op7_counts(spark):
    docs = texts_of(spark, SF)
    for r in QUERIES["op7_quality_rules"](spark, SF).collect():
        text = docs[r.doc_id] or ""
        ws = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        threes = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
        hit = {k for i in range(len(ws) - 2) if threes[tuple(ws[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(ws) < 50 or 100 * len(hit) > 50 * len(ws))
        assert not (r.kept and r.base_failed)


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, 0.1), (3, 20, 0.05), (20, 20, 0.5), (150, 4000, 0.05)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 1000 else None
        if exact is None:
            exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                                       + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        assert quality.tail(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_cutoffs_are_certified_on_the_holdout():
    steps = len(quality.LADDER) + 1
    good = np.zeros((2, 2, steps), np.int64)
    good[:, 1, 0] = 2000          # good texts pass no cutoff
    good[:, 0, 10] = 300          # low quality passes ten
    few = good // 100             # too few labels to certify anything
    bad = good.copy()
    bad[1, 1, 12] = 400           # the holdout rejects too many good texts
    assert set(quality.certify({("x", "symbols"): good, ("y", "symbols"): few, ("z", "symbols"): bad})) == {("x", "symbols")}


def test_op9_follows_the_targets(spark):
    rows = QUERIES["op9_mix_sources"](spark, SF).collect()
    assert sorted(rows) == sorted(QUERIES["op9_mix_sources"](spark, SF).collect())
    docs = texts_of(spark, SF)
    by: dict = {}
    for r in rows:
        assert r.size == len(WORD.findall(docs[r.doc_id] or "")) and r.taken in (0, r.size, 2 * r.size)
        by.setdefault(r.source, []).append(r)
    total = 1.5 * sum(r.size for r in rows)
    sizes = {s: sum(r.size for r in rs) for s, rs in by.items()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, left, open_ = {}, total, set(sizes)
    while full := [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * sizes[s]]:
        for s in full:
            target[s] = 2 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= set(full)
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s, rs in by.items():
        assert rs[0].source_size == sizes[s] and rs[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in rs) - target[s]) <= max(r.size for r in rs)


def test_overlapping_sources_share_by_flow(spark):
    """Words of both sources serve the one whose own words do not reach."""
    flow = mixing.route([100, 50, 100], [["a"], ["b"], ["a", "b"]], {"a": 120, "b": 120}, 2)
    assert sum(f.get("a", 0) for f in flow) == 120 and sum(f.get("b", 0) for f in flow) == 120
    assert all(sum(f.values()) <= c for f, c in zip(flow, [100, 50, 100]))  # nothing is repeated
    flow = mixing.route([10, 10], [["a"], ["a", "b"]], {"a": 30, "b": 10}, 2)
    assert [sum(f.values()) for f in flow] == [20, 20]
    rows = [(i, "w " * 9 + str(i), ["a"] if i < 200 else ["b"] if i < 250 else ["a", "b"]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, text string, sources array<string>")
    mixed = mixing.mix(df, F.col("sources"), mixing.word_count(F.col("text")), F.xxhash64("id"), ["id"], rows_per_bucket=20)
    got = mixed.select(F.explode("shares").alias("s")).groupBy("s.source").agg(F.sum("s.words").alias("n")).collect()
    goals = {g.source: g.target for r in mixed.select("goals").distinct().collect() for g in r.goals}
    assert {r.source: r.n for r in got} == pytest.approx(goals, abs=40)


def test_crowded_conversations_are_cut_in_parts(spark):
    rows = [(1, k // 3, ["ann", "bob", "system"][k % 3], f"t{k}") for k in range(600)] + [(1, 7, "ann", "again")] * 90
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate(df, most=40).collect()
    assert {r.perspective for r in got} == {"ann", "bob"} and max(r.turns for r in got) <= 80
    mine = [r for r in got if r.perspective == "ann"]
    whole = "".join(r.text for r in sorted(mine, key=lambda r: tuple(-1 << 62 if x is None else x for x in r.part)))
    turns = [int(m) for m in re.findall(r"\bt(\d+)<", whole)]
    assert len(turns) == 600 and [t // 3 for t in turns] == sorted(t // 3 for t in turns)
    assert whole.count("again") == 90
    said = sum(m.stop - m.start for r in mine for m in r.masks)
    assert said == sum(len(x[3]) + len(chat.END) for x in rows if x[2] == "ann")


def test_crowded_conversations_keep_the_order_of_equal_turns(spark, tmp_path):
    """Parts follow turn, speaker and text, and the query gives one row for a block, as its SQL does."""
    rows = [(1, None if k % 2 else 3, ["ann", "bob"][k % 7 > 3], f"t{k * 37 % 1400}") for k in range(1400)] + [(1, 3, "ann", "t5")] * 700
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = [r for r in chat.rotate(df, most=100).collect() if r.perspective == "ann"]
    got.sort(key=lambda r: (r.part.block is not None, r.part.number))
    assert max(r.turns for r in got) <= 100 and len({r.part for r in got}) == len(got)
    said = [m for r in got for m in re.findall(r"(t\d+)<", r.text)]
    assert said == [r[3] for r in sorted(rows, key=lambda r: (r[1] is not None, r[2], r[3]))]
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(ORACLE["op2_chat_perspectives"]).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in QUERIES["op2_chat_perspectives"](spark, str(tmp_path)).collect())


# ------------------------------------------------------------------ pipeline

def test_near_copies_keep_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in nearcopies.one_of_each(docs).select("doc_id").collect()}
    sets = {i: frozenset(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for i, t in texts_of(spark, SF).items()}
    holders: dict = {}
    for i, s in sets.items():
        for h in s or {0}:
            holders.setdefault(h, []).append(i)
    near = {i: set() for i in sets}
    for i, s in sets.items():
        for j, n in Counter(j for h in s or {0} for j in holders[h]).items():
            if j != i and n >= 0.8 * len(s | sets[j] or {0}):
                near[i].add(j)
    roots = smallest_reachable(sets, lambda a, b: b in near[a])
    assert kept == set(roots.values())


def jaccard(a, b):
    one, two = (set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in (a, b))
    return len(one & two) / len(one | two)


def test_near_copies_among_texts_of_one_template(spark):
    """Alike texts that are no copies don't keep a copy from being verified."""
    template = words(0, 170, 10**6).split()
    texts = [" ".join(template + words(k, 24, 10**6).split()) for k in range(1, 401)]
    copies = [" ".join(t.split()[:-7] + words(1000 + k, 6, 10**6).split()) for k, t in enumerate(texts[:60])]
    assert jaccard(texts[70], texts[71]) < 0.79 and all(0.8 < jaccard(t, c) < 0.95 for t, c in zip(texts, copies))
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in nearcopies.one_of_each(docs).collect()} == set(range(400))


@pytest.mark.parametrize("size", [150, 600])
def test_verified_links_follow_the_members(spark, size):
    """Texts of one template, none a copy of another: no pair leaves its task; true groups send a forest."""
    base = words(5, 200, 10**6).split()
    chance = random.Random(size)
    texts = []
    for k in range(size):
        w = list(base)
        for at in chance.sample(range(200), 3):
            w[at] = f"x{k}y{at}"
        texts.append(w)
    sets = spark.createDataFrame([(k, 0, sorted({hash(" ".join(w[i:i + 5])) for i in range(196)})) for k, w in enumerate(texts)],
                                 "sig long, cluster long, shingles array<long>")
    found = {(r.a, r.b) for r in nearcopies.links(sets, 0.8).collect()}
    exact = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    own = [{hash(" ".join(w[i:i + 5])) for i in range(196)} for w in texts]
    true = {(a, b) for a in range(size) for b in range(a) if exact(own[a], own[b])}
    assert len(found) < size
    roots = smallest_reachable(range(size), lambda a, b: (max(a, b), min(a, b)) in true)
    linked = smallest_reachable(range(size), lambda a, b: (a, b) in found or (b, a) in found)
    assert roots == linked


@pytest.mark.parametrize("chunk", [3, 8, 1000])
def test_clusters_of_several_chunks_lose_no_link(spark, chunk):
    """One large group, stragglers linked to its edge, and chains, whatever the size of a chunk."""
    chance = random.Random(7)
    sets = [set(range(k, k + 60)) for k in [0] * 20 + list(range(0, 120, 5)) + [400, 403, 409, 800]]
    sets = [s - set(chance.sample(sorted(s), 2)) for s in sets]
    df = spark.createDataFrame([(k, 5, sorted(s)) for k, s in enumerate(sets)], "sig long, cluster long, shingles array<long>")
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    edges = {(r.a, r.b) for r in nearcopies.links(df, 0.8, chunk=chunk).collect()}
    n = range(len(sets))
    assert smallest_reachable(n, lambda a, b: (a, b) in edges or (b, a) in edges) == smallest_reachable(n, near)


def test_near_copies_with_a_repeated_passage(spark):
    """Shingles count once, however often a text repeats them."""
    texts = []
    for k in range(8):
        text, passage = words(k, 700, 10**6), words(100 + k, 15, 10**6)
        texts += [f"{text} {passage}", " ".join([text, *[passage] * 40])]
    assert all(jaccard(a, b) > 0.95 for a, b in zip(texts[::2], texts[1::2]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in nearcopies.one_of_each(docs).collect()} == set(range(0, 16, 2))


def test_pipeline_drops_near_copies_by_fingerprint(spark):
    """Texts within three bits but below the similarity of shingle sets: only the tiles of fingerprints find them."""
    chance = random.Random(0)
    texts = []
    for k in range(12):
        base = [f"w{chance.randrange(10 ** 6)}" for _ in range(30)] * 40
        texts += [base, base + [f"v{k}x{j}" for j in range(30)]]        # a tail of its own: many new kinds, few repeats
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)] + [(99, None), (98, ""), (None, " ")], "doc_id long, text string")
    fps = [simhash.fingerprint(" ".join(t).encode(), 3) for t in texts]
    roots = smallest_reachable(range(len(texts)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert len(set(roots.values())) < len(texts)
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == {*roots.values(), 98}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == {*roots.values(), 98}
    assert nearcopies.one_of_each(docs).count() == len(texts) + 1


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.schema.names == docs.schema.names
        before, left = {r.doc_id for r in docs.collect()}, {r.doc_id for r in after.collect()}
        assert left <= before and len(left) > 0.8 * len(before)
        if name == "toxicity":
            assert len(toxic & left) <= 0.5 * len(toxic & before)  # some marked texts hold no telling word
        docs = after
    texts = " ".join(r.text or "" for r in docs.collect())
    assert not re.search(r"AKIA[A-Z2-7]{16}|password=[0-9a-f]{18}", texts)
    assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()


def test_mixing_starts_no_python_worker(spark):
    """The plan of the mix is a local table; Spark reads a list of rows through Python workers of their own."""
    plan = mixing.mix_rows(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "LocalRelation" in plan
    assert not re.search("LogicalRDD.*for_pattern|ExistingRDD.*for_pattern", plan)


def test_workers_hold_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    docs = spark.range(3000).coalesce(1).select(F.repeat(F.lit("word "), 400).alias("text"))
    held = [r.bytes for r in common.bounded_batches(docs).mapInArrow(common.lean(sizes), "bytes long").collect()]
    assert sum(held) >= 3000 * 2000 and max(held) < 1.1 * (1 << 20)


def test_nothing_else_imports_the_subpackage():
    import pathlib
    root = pathlib.Path(corpus_pipeline.__file__).parent
    others = [p for folder in ("tidemark", "checks") for p in (root / folder).rglob("*.py") if "llm" not in p.parts]
    assert others and not any("llm" in p.read_text() for p in others)
