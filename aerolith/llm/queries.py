"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import bpe, fingerprints, hard_negatives, language_id, language_model, merkle, packing, repeats, simhash, super_kmers, token_counts, toxicity, vector_search
from aerolith.llm.common import id_remainder, shared_dir, table

GPT_JSON = public_tokenizers.path("byte_bpe_50k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, id_remainder(4) != 2)
    return language_id.identify(docs.select("doc_id", "text", (id_remainder(4) == 2).alias("held_out")), model)


def op3_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", vector_search.quantised(F.col("embedding")).alias("vector"))
    return vector_search.top_k(vectors, F.col("vec_id") % 100 == 0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), GPT_JSON)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = language_model.score(table(spark, sf_dir, "documents"), id_remainder(10) != 0)
    return scores.withColumn("held_out", id_remainder(10) == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), MULTI_RANKS)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), id_remainder(3) != 1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that the query's work doesn't hang on earlier runs."""
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), GPT_JSON, shared_dir(spark))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.removal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), vector_search.quantised(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 2 divides the crc32 of an id, the text shown has lost its line ends."""
    changed = F.when(id_remainder(2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    shown = merkle.verify(table(spark, sf_dir, "documents"), changed)
    return shown.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = super_kmers.removal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_lz_fingerprints, op2_language_id, op3_ball_tree, op4_packing, op5_language_model, op6_bpe, op7_toxicity, op8_token_counts, op9_simhash, op10_repeats, op11_hard_negatives, op12_merkle_manifest, op13_super_kmers)}

SQL: dict[str, str] = {
    "op3_ball_tree": """
WITH usable AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
one AS (SELECT vec_id, min(v) AS v FROM usable GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM one q JOIN one c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op11_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, c.v)]) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scored WHERE alike)
  WHERE r <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
  WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
""",
    "op12_merkle_manifest": """
WITH RECURSIVE told AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS now, head
  FROM told),
placed AS (
  SELECT doc_id, tree, leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS shown,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos AS idx, leaf AS hash, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), CAST(ceil(n / 3) AS BIGINT)
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n),
tops AS (
  SELECT 'top' AS tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS idx, hash, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), CAST(ceil(n / 3) AS BIGINT)
  FROM tops WHERE n > 1 GROUP BY tree, level, idx // 3, n),
places AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS idx, hash FROM nodes WHERE n = 1),
every AS (SELECT * FROM nodes UNION ALL SELECT * FROM tops),
sides AS (
  SELECT a.tree, a.level, a.idx, a.n, coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS before,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS after
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.idx, a.n),
steps AS (
  SELECT s.tree, s.level, s.idx, before, after, CASE WHEN s.n <= 3 THEN (CASE WHEN s.tree = 'top' THEN NULL ELSE 'top' END) ELSE s.tree END AS up_tree,
    CASE WHEN s.n <= 3 THEN 0 ELSE s.level + 1 END AS up_level, CASE WHEN s.n <= 3 THEN p.idx ELSE s.idx // 3 END AS up_idx
  FROM sides s LEFT JOIN places p ON s.tree = p.tree),
climb AS (
  SELECT q.doc_id, q.tree AS own, q.pos, CASE WHEN n = 1 THEN 'top' ELSE q.tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN p.idx ELSE q.pos END AS idx,
    q.shown AS folded, '' AS proof, 0 AS step
  FROM placed q JOIN places p ON q.tree = p.tree
  UNION ALL
  SELECT c.doc_id, c.own, c.pos, s.up_tree, s.up_level, s.up_idx, sha256(s.before || c.folded || s.after), c.proof || s.before || s.after, c.step + 1
  FROM climb c JOIN steps s ON c.tree = s.tree AND c.level = s.level AND c.idx = s.idx),
ends AS (SELECT own, pos, max_by(folded, step) AS folded_root, max_by(proof, step) AS proof FROM climb GROUP BY own, pos),
root AS (SELECT hash FROM tops WHERE n = 1)
SELECT q.doc_id, q.leaf, p.hash AS subroot, root.hash AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = root.hash AS verified
FROM placed q JOIN ends e ON q.tree = e.own AND q.pos = e.pos JOIN places p ON q.tree = p.tree CROSS JOIN root
""",
    "op13_super_kmers": """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM texts),
starts AS (
  SELECT doc_id, p, word, string_agg(word, ' ') OVER ahead AS own, count(*) OVER ahead AS n
  FROM places WINDOW ahead AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
windows AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY own ORDER BY doc_id, p) > 1 AS later
  FROM starts WHERE n = 20),
covered AS (
  SELECT a.doc_id, a.p, a.word, max(CASE WHEN w.later THEN w.p END) OVER (PARTITION BY a.doc_id ORDER BY a.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
  FROM places a LEFT JOIN windows w ON a.doc_id = w.doc_id AND a.p = w.p),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE last >= p - 19) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE last IS NULL OR last < p - 19) AS text
  FROM covered GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
""",
}
