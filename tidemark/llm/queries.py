"""The registered queries of the text operators: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (centroids, chat, decontaminate, langid, mixing, quality, secretscan, sharding, simhash, spelling, suffix_array,
                          suffix_tree, toxicity)
from tidemark.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id")) == 2
    return langid.identify(docs, ~held_out, [F.col("doc_id"), held_out.alias("held_out")])


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = chat.rotate(table(spark, sf_dir, "conversations"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m.start, m.stop)), ",")
    return shown.select("conv_id", "perspective", F.col("part.block").alias("part"), F.col("part.number").alias("number"), F.col("turns").cast("long").alias("turns"),
                        "text", masks.alias("masks"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_tree.dedup(table(spark, sf_dir, "documents"), window=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scanner = secretscan.fit(docs, path=F.col("source"))
    found = secretscan.scan(docs, scanner, [F.col("doc_id")], F.col("source"))
    return found.select("doc_id", F.col("start").cast("long").alias("start"), F.char_length("value").cast("long").alias("length"),
                        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "secret")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_array.dedup(table(spark, sf_dir, "documents"), length=400)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), F.coalesce("lang", F.lit("und")),
                           fold(F.col("doc_id")) == 2)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("long").alias("start"),
                        F.col("matched").cast("long").alias("matched"), F.col("item_words").cast("long").alias("item_words"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id")) == 2
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, machine, [F.col("doc_id"), held_out.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = sharding.pack(table(spark, sf_dir, "documents"), shards=40)
    return packed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_secret_scans": op4_secret_scans,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_mix_sources": op9_mix_sources,
    "op10_toxicity": op10_toxicity,
    "op11_sharding": op11_sharding,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_spelling_variants": op13_spelling_variants,
}

def _mask_words(words: str, at: str, number: int) -> str:
    return f"'{number}:' || " + " || ' ' || ".join(f"{words}[{at} + {place + 1}]" for place in decontaminate.MASKS[number])


_SEEDS = """
    SELECT {id}, q, {seed} AS seed FROM (SELECT {id}, w, unnest(range(0, len(w) - {span} + 1)) AS q FROM {table})
"""


def _all_seeds(table_: str, id_: str, span_of: list[int]) -> str:
    return " UNION ALL ".join(_SEEDS.format(id=id_, table=table_, span=span_of[n], seed=_mask_words("w", "q", n))
                              for n in range(len(decontaminate.MASKS)))


def _clusters() -> str:
    """Three rounds and a last assignment, unrolled; centroids are lists that whole lists are compared with."""
    gap = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = ["""v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x
             FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
             """c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS k, x FROM v
             QUALIFY k < 16)"""]
    for r in range(4):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(k, (gap, k)) AS k, min(gap) AS gap
                     FROM (SELECT rid, k, {gap} AS gap FROM v CROSS JOIN c{r} c) GROUP BY rid)""")
        if r < 3:
            steps.append(f"""m{r} AS (SELECT k, list(m ORDER BY i) AS x FROM (
                         SELECT k, i, ((s - ((s % n + n) % n)) // n)::BIGINT AS m FROM (
                         SELECT k, i, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
                         SELECT k, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM v JOIN a{r} USING (rid)) GROUP BY k, i)) GROUP BY k)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (k))")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, k::INT AS cluster, gap AS distance, (sum(gap) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(gap) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN v USING (rid) JOIN c3 USING (k)
"""


_SPANS = [m[-1] + 1 for m in decontaminate.MASKS]
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"

ORACLE: dict[str, str] = {
    "op2_chat_perspectives": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
                  floor(turn / {chat.BLOCK}.0)::BIGINT AS part FROM conversations),
cut AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, speaker, text) - 1) // {chat.MOST} AS number FROM t),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{chat.SYSTEM}'),
heads AS (SELECT cut.*, perspective, speaker = perspective AS mine,
                 CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = '{chat.SYSTEM}' THEN '<|system|>'
                      ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
          FROM cut JOIN p ON cut.conv_id IS NOT DISTINCT FROM p.conv_id),
lines AS (SELECT *, head || text || '<|end|>' || chr(10) AS line FROM heads),
placed AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, perspective, part, number ORDER BY turn, speaker, text
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin_at FROM lines)
SELECT conv_id, perspective, part, number, count(*) AS turns, string_agg(line, '' ORDER BY turn, speaker, text) AS text,
       coalesce(string_agg((begin_at + length(head)) || '-' || (begin_at + length(line)), ',' ORDER BY begin_at) FILTER (mine), '') AS masks
FROM placed GROUP BY conv_id, perspective, part, number
""",
    # Every window is hashed and counted; a word is covered if one of the 35 windows over it repeats.
    "op3_substring_dedup": r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS h
                         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
repeats AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT doc_id, p, true AS hit FROM windows JOIN repeats USING (h)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
marked AS (SELECT doc_id, p, word, coalesce(bool_or(hit) OVER (
             PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone
           FROM words LEFT JOIN hits USING (doc_id, p)),
told AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
         FROM marked GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN told USING (doc_id)
""",
    # Seeds as joined words; then every place of a diagonal is compared and windows are summed.
    "op8_benchmark_decontamination": f"""
WITH dw AS MATERIALIZED (SELECT doc_id, {_TOKENS} AS w FROM documents WHERE text IS NOT NULL),
iw AS MATERIALIZED (SELECT item_id, w FROM (SELECT item_id, {_TOKENS} AS w FROM benchmark WHERE text IS NOT NULL)
                    WHERE len(w) >= {decontaminate.SPAN}),
ds AS ({_all_seeds("dw", "doc_id", _SPANS)}),
bs AS ({_all_seeds("iw", "item_id", [decontaminate.SPAN] * len(_SPANS))}),
diagonals AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, ds.q - bs.q AS start FROM ds JOIN bs USING (seed)),
places AS (SELECT d.*, len(iw.w) AS n, unnest(range(0, len(iw.w))) AS q, iw.w AS item, dw.w AS doc
           FROM diagonals d JOIN iw USING (item_id) JOIN dw USING (doc_id)),
agree AS (SELECT doc_id, item_id, start, n, q,
                 CASE WHEN start + q >= 0 AND start + q < len(doc) AND doc[start + q + 1] = item[q + 1] THEN 1 ELSE 0 END AS same
          FROM places),
windows AS (SELECT *, sum(same) OVER w15 AS in_window, count(*) OVER w15 AS size FROM agree
            WINDOW w15 AS (PARTITION BY doc_id, item_id, start ORDER BY q
                           ROWS BETWEEN CURRENT ROW AND {decontaminate.WINDOW - 1} FOLLOWING)),
scored AS (SELECT doc_id, item_id, start, n, sum(same) AS matched,
                  max(in_window) FILTER (size = least(n, {decontaminate.WINDOW})) AS best
           FROM windows GROUP BY doc_id, item_id, start, n)
SELECT doc_id, item_id, arg_max(start, (matched, -start))::BIGINT AS start, max(matched)::BIGINT AS matched,
       max(n)::BIGINT AS item_words
FROM scored WHERE best >= ceil(least(n, {decontaminate.WINDOW}) * {decontaminate.SHARE})
GROUP BY doc_id, item_id
""",
    "op12_centroid_clusters": _clusters(),
    # The checksum is worked out bit by bit from its polynomial; near words meet in what is left without one letter.
    "op13_spelling_variants": r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents) GROUP BY ALL),
spelt AS (SELECT run, times, list_concat([4294967295], flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                      ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::BIGINT[] END))) AS bytes FROM runs),
summed AS (SELECT run, times, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM spelt, bits),
words AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, times FROM summed)
  GROUP BY word HAVING sum(times) >= 2 AND length(word) >= 7),
lost AS MATERIALIZED (SELECT word, n, i, word[1:i] || word[i + 2:] AS rest
                      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM lost a JOIN lost b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM lost a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM lost a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS form_n, any_value(n) AS n FROM near GROUP BY word),
forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 10 * n),
chain AS (SELECT word, form AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word),
ends AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, form, forms.form_n, coalesce(root, word) AS root
FROM words LEFT JOIN (SELECT word, n_near FROM best) USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
""",
}
