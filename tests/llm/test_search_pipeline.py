"""Operator 3 against brute force and SQL, and the pipeline's stages on their own inputs."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm import queries, vector_search

from .test_documents import plain_removal


def plain_top(rows, k=10):
    best = {}
    for i, v in rows:
        if i not in best or v < best[i]:
            best[i] = v
    out = []
    for q, v in best.items():
        if q % 100 == 0:
            scored = sorted((-int(np.dot(v, w)), i) for i, w in best.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_search(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.integers(-3, 4, 5).tolist()) for i in range(900)] + [(100, [0] * 5), (901, [1, 2]), (902, [100, 200, 300, 400, 500])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    for shard, block in ((16_384, 2_048), (100, 3)):
        found = vector_search.top_k(df, F.col("vec_id") % 100 == 0, shard_rows=shard, block_rows=block)
        assert sorted(map(tuple, found.collect())) == plain_top(rows)


def test_clustered_vectors_are_pruned(monkeypatch):
    """Bounds leave out most pairs where vectors lie in balls far apart, and the answer is that of all pairs."""
    rng = np.random.default_rng(11)
    centres = rng.integers(-1000, 1000, (16, 24)) * 20
    vectors = np.concatenate([c + rng.integers(-20, 21, (500, 24)) for c in centres]).astype(np.int64)
    ids, queries = np.arange(len(vectors)), vectors[::100]
    met, products = [], vector_search.exact_products
    monkeypatch.setattr(vector_search, "exact_products", lambda q, v: met.append(len(q) * len(v)) or products(q, v))
    scores, _ = vector_search.search(queries, ids[::100], np.full(len(queries), np.iinfo(np.int64).min), vectors, ids, 10)
    every = queries @ vectors.T
    every[np.arange(len(queries)), ids[::100]] = np.iinfo(np.int64).min
    assert (np.sort(every, axis=1)[:, ::-1][:, :10] == scores).all()
    assert sum(met) < 0.5 * len(queries) * len(vectors)


def test_search_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [None, 1.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 0.0]), (4, None), (5, []), (6, [-0.0001, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = df.select("vec_id", vector_search.quantised(F.col("embedding")).alias("vector"))
    assert [tuple(r) for r in vector_search.top_k(vectors, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 6, -1024 + 2048 * 1024)]
    assert vector_search.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_search_query_is_the_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert sorted(map(tuple, queries.op3_ball_tree(spark, small).collect())) == sorted(con.sql(queries.SQL["op3_ball_tree"]).fetchall())


def test_stages(spark, small, documents):
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        kept.append(docs.count())
    assert documents.count() >= kept[0] >= kept[1] >= kept[2] >= kept[3] > 0
    assert kept[0] >= 0.95 * documents.count()


def test_repeat_stage_against_plain(spark, small, documents):
    want = plain_removal({r["doc_id"]: r["text"] for r in documents.collect()})
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeats(spark, documents, small).collect()}
    assert found == {i: w[3].decode(errors="ignore") for i, w in want.items() if w[3].decode(errors="ignore")}


def test_near_duplicate_stage_keeps_one_of_each_group(spark, frame, small):
    texts = ["one two three four five six seven"] * 2 + ["other words stand in this text here", "a third text of its own making now"]
    docs = frame([texts[0], *texts[1:]], [1, 2, 3, 4])
    found = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, small).collect())
    assert found == [1, 3, 4]


def edited(rng, words, n):
    """The words with n single words replaced, far enough apart that each changes five shingles."""
    out = list(words)
    for i in rng.choice(len(words) // 10, n, replace=False):
        out[10 * i + 5] = f"edit{rng.integers(1 << 40)}"
    return " ".join(out)


def jaccard(x, y):
    a, b = ({tuple(t.lower().split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (x, y))
    return len(a & b) / len(a | b)


def test_near_duplicate_stage_finds_edited_copies(spark, frame, small):
    rng = np.random.default_rng(6)
    texts, want = [], []
    for k, edits in enumerate([1, 2, 3, 4, 4, 4, 4, 4, 6, 9] * 4):  # of 200 words: Jaccard 0.95 to 0.81; 0.73 and 0.63 stay
        words = [f"w{x}" for x in rng.integers(0, 1 << 30, 200)]
        copy = edited(rng, words, edits)
        want += [2 * k] + ([2 * k + 1] if jaccard(" ".join(words), copy) < 0.8 else [])
        texts += [" ".join(words), copy]
    assert len(want) == 48
    found = corpus_pipeline.drop_near_duplicates(spark, frame(texts), small)
    assert sorted(r["doc_id"] for r in found.collect()) == want


def test_near_duplicate_stage_on_a_large_group(spark, frame, small):
    """A chain of copies, each like its neighbours only, is one group, in whichever buckets its links are."""
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in rng.integers(0, 1 << 30, 400)]
    texts = []
    for i in range(40):
        words[10 * i + 5] = f"edit{i}"
        texts.append(" ".join(words))
    assert jaccard(texts[0], texts[39]) < 0.5
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, frame(texts), small).collect()] == [0]


def test_sketches_estimate_similarity(frame):
    from aerolith.llm import near_copies

    rng = np.random.default_rng(8)
    words = [f"w{x}" for x in rng.integers(0, 1 << 30, 300)]
    texts = [" ".join(words), edited(rng, words, 5), edited(rng, words, 20), " ".join(words[::-1])]
    rows = near_copies.signatures(frame(texts).withColumn("row_key", F.col("doc_id"))).orderBy("doc_id").collect()
    sketch = np.stack([np.frombuffer(r["sketch"], np.uint64) for r in rows])
    found = near_copies.estimates(sketch, sketch)
    for i in range(4):
        for j in range(4):
            assert abs(found[i, j] - jaccard(texts[i], texts[j])) < 0.17


def test_near_duplicate_stage_joins_groups_of_one_bucket(spark, frame, small):
    """Many texts share most of a long passage; the pairs of copies among them are found, without pairs of the others."""
    rng = np.random.default_rng(9)
    shared = [f"s{x}" for x in rng.integers(0, 1 << 30, 120)]
    texts, want = [], []
    for k in range(60):
        own = [f"w{x}" for x in rng.integers(0, 1 << 30, 80)]
        texts += [" ".join(shared + own), " ".join(shared + own[:-2] + ["x", "y"])]
        want.append(2 * k)
    assert jaccard(texts[0], texts[2]) < 0.6 < 0.8 < jaccard(texts[0], texts[1])
    found = corpus_pipeline.drop_near_duplicates(spark, frame(texts), small)
    assert sorted(r["doc_id"] for r in found.collect()) == want


def test_near_copies_link_by_simhash_first(spark, frame, monkeypatch):
    """With MinHash tables that find nothing, what fingerprints link within their radius is still joined, if the sets confirm it."""
    from aerolith.llm import near_copies, simhash

    rng = np.random.default_rng(8)
    long = [f"w{i}" for i in rng.integers(0, 1 << 30, 9000)]
    edited = [*long[:4500], "other", *long[4501:]]
    # Repeats rule a fingerprint, not a set: these two link by SimHash and share few shingles.
    echo = " ".join(["one two three four five six seven"] * 400)
    texts = [" ".join(long), " ".join(edited), echo + " " + " ".join(f"x{i}" for i in range(60)), echo + " " + " ".join(f"y{i}" for i in range(60)), "nothing like it"]
    bits = [simhash.text_simhash(t, near_copies.SHINGLE) for t in texts]
    assert (bits[0] ^ bits[1]).bit_count() <= simhash.RADIUS and (bits[2] ^ bits[3]).bit_count() <= simhash.RADIUS
    rows = frame(texts).withColumn("row_key", F.col("doc_id"))
    signed = near_copies.signatures(rows).withColumn("keys", F.array(F.col("set_id")))
    monkeypatch.setattr(near_copies, "signatures", lambda *_: signed)
    groups = near_copies.near_copies(rows).groupBy("root").agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).collect()
    ids = [r["doc_id"] for r in rows.orderBy("doc_id").collect()]
    assert sorted(r["ids"] for r in groups) == [ids[:2], *[[i] for i in ids[2:]]]


def test_near_copies_against_all_pairs(spark, frame, monkeypatch):
    """Groups are those of all pairs at 0.8 or more, where buckets mix texts at 0.6 to 0.95, met whole and block by block."""
    from aerolith.llm import near_copies

    rng = np.random.default_rng(12)
    texts = []
    for _ in range(3):
        words = [f"w{x}" for x in rng.integers(0, 1 << 30, 250)]
        texts += [" ".join(words)] + [edited(rng, words, int(n)) for n in rng.integers(1, 8, 60)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if root[i] != root[j] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root = [root[j] if r == root[i] else r for r in root]
    want = {frozenset(np.flatnonzero(np.array(root) == r).tolist()) for r in root}
    assert 3 < len(want) < len(texts)
    rows = frame(texts).withColumn("row_key", F.col("doc_id"))
    for size in (near_copies.BLOCK_BYTES, 8_000):
        monkeypatch.setattr(near_copies, "BLOCK_BYTES", size)
        groups = near_copies.near_copies(rows).groupBy("root").agg(F.collect_list("doc_id").alias("ids")).collect()
        assert {frozenset(r["ids"]) for r in groups} == want


def test_run_on_an_empty_table_and_odd_rows(spark, frame, small, tmp_path):
    """No row is lost but by the stages' rules; an empty table gives no pieces."""
    texts = ["Die Sonne scheint heute über dem kleinen Dorf und die Kinder spielen im Garten."] + [None, "", "12 34"]
    for name, docs in (("odd", frame(texts, [7, None, 3, 3]).select("doc_id", "text", "lang", "source", "n_chars")), ("none", frame([]).select("doc_id", "text", "lang", "source", "n_chars"))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).count() == 0  # without learnt languages no document is told


def test_near_duplicate_stage_keeps_texts_that_share_an_id(spark, frame, small):
    """Null and repeated ids don't make dissimilar texts copies; of each group one row stays, one with an id if there is one."""
    texts = [f"text {k} " + " ".join(f"w{k}x{i}" for i in range(20)) for k in range(6)]
    docs = frame([*texts, texts[0], texts[1], texts[3], texts[5]], [None, None, None, 7, 7, 7, None, 3, 7, None])
    found = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()]
    assert sorted(found, key=str) == sorted([(None, texts[0]), (3, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[5])], key=str)


def test_run_with_learnt_models_keeps_and_drops_named_rows(spark, small, documents, tmp_path):
    """Clean rows come out whole, whatever their id or repetition; rows without letters and copies don't. Toxic rows are not
    planted: so few labels mark no words; the held-out test of operator 7 covers its decisions."""
    rows = documents.where("lang is not null and length(text) > 400").orderBy("doc_id").limit(3).collect()
    labels = spark.read.parquet(f"{small}/labels.parquet")
    turned = [" ".join(reversed(r["text"].split()[:60])) for r in rows]
    copy = rows[0]["text"].split()
    copy[len(copy) // 2] = "changed"
    odd = [(None, turned[0]), (9_000_001, turned[1]), (9_000_001, turned[2]), (9_000_002, None), (9_000_003, ""), (9_000_004, "12 34"), (9_000_005, turned[1]), (9_000_006, " ".join(copy))]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], documents.select("doc_id", "text", "lang", "source", "n_chars").schema)
    documents.select(*extra.columns).union(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r["offset"] + r["length"] <= 2048 for r in pieces)
    starts = [r["doc_id"] for r in pieces if r["start"] == 0]
    assert starts.count(None) == 1 and starts.count(9_000_001) == 2
    assert {i for i in starts if i and i > 9_000_001} == set()
    for i in {r["doc_id"] for r in pieces} - {9_000_001}:
        own = sorted((r["start"], r["length"], r["doc_tokens"]) for r in pieces if r["doc_id"] == i)
        assert own[0][0] == 0 and sum(x[1] for x in own) == own[0][2]
