"""Operators 4, 6 and 8 against the libraries, and round trips."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolith.llm import bpe, packing, queries, token_counts

from .conftest import EDGES

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = Tokenizer.from_file(JSON)
with open(RANKS, "rb") as f:
    ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
PIECES = st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "'s", "'re", "'", "1", "²", "é", "漢", "😀", "　", "ing", "!", "_", "’", "<|endoftext|>", "<|end", "\r\n", "Z" * 9]), max_size=25).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=20)), min_size=1, max_size=6))
def test_ids_are_the_libraries(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ends = bpe.from_ranks(RANKS).encode_rows(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [ENCODING.encode_ordinary(t) for t in texts]
    ids, ends = bpe.encode_like_library(JSON, pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=10), st.data())
def test_appends_and_edits_keep_tables_exact(data, put, draw):
    encoder = bpe.from_ranks(RANKS)
    stored = encoder.last_tokens(data, [])
    more, longer = encoder.append(data, list(stored), put)
    assert longer == encoder.last_tokens(more, [])
    at = draw.draw(st.integers(0, len(data)))
    new, edited = encoder.edit(data, list(stored), at, min(3, len(data) - at), put)
    assert edited == encoder.last_tokens(new, []) and b"".join(encoder.bytes_of[t] for t in encoder.walk(new, edited)) == new


def test_bpe_operator(frame):
    found = {r["doc_id"]: r for r in bpe.encode_digests(frame(EDGES), RANKS).collect()}
    lists = {r["doc_id"]: r for r in bpe.encode_documents(frame(EDGES), RANKS).collect()}
    for i, t in enumerate(EDGES):
        ids = ENCODING.encode_ordinary(t or "")
        assert lists[i]["ids"] == ids and bytes(lists[i]["decoded"]) == (t or "").encode()
        assert found[i]["n_tokens"] == len(ids) and found[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_query(spark, small, documents):
    found = {r["doc_id"]: r["n_tokens"] for r in queries.op6_bpe(spark, small).collect()}
    assert found == {r["doc_id"]: len(ENCODING.encode_ordinary(r["text"])) for r in documents.collect()}


def check_packing(rows, texts):
    ids = {i: [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            own = np.array(ids[i][p["start"] : p["start"] + p["length"]], "<u4")
            assert p["start"] == at and p["doc_tokens"] == len(ids[i]) and p["ids_crc32"] == zlib.crc32(own.tobytes())
            at += p["length"]
        assert at == len(ids[i])
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        sizes.append(at)
    return sizes


def test_packing_operator(frame):
    check_packing(packing.pack(frame(EDGES), JSON).collect(), dict(enumerate(e for e in EDGES)))
    assert packing.pack(frame([]), JSON).count() == 0


def test_packing_query(spark, small, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    sizes = check_packing(queries.op4_packing(spark, small).collect(), texts)
    assert sum(2048 - s for s in sizes) / (2048 * len(sizes)) < 0.02


def test_short_documents_stay_whole(spark, small, documents):
    rows = queries.op4_packing(spark, small).collect()
    fitting = {r["doc_id"] for r in rows if r["doc_tokens"] <= 2048}
    torn = Counter(r["doc_id"] for r in rows if r["doc_id"] in fitting)
    assert sum(n > 1 for n in torn.values()) < 0.1 * len(fitting)
    tokens = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert len(rows) < 1.1 * (len(tokens) + sum(tokens.values()) / 2048)  # concatenating and cutting gives about as many


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), min_size=1, max_size=120))
def test_partition(sizes):
    windows = packing.partition([(i, 0, s) for i, s in enumerate(sizes)], 2048)
    loads = [sum(p[2] for p in w) for w in windows]
    least = -(-sum(sizes) // 2048)
    assert max(loads) <= 2048 and len(windows) <= least + max(1, least // 50)
    pieces = sorted(p for w in packing.joined(windows) for p in w)
    assert [sum(n for d, _, n in pieces if d == i) for i in range(len(sizes))] == sizes
    for i in range(len(sizes)):
        at = 0
        for _, start, n in (p for p in pieces if p[0] == i):
            assert start == at
            at += n


def test_partition_keeps_whole_what_fits():
    sizes = [(i * 7919) % 1000 + 1 for i in range(200)]
    windows = packing.partition([(i, 0, s) for i, s in enumerate(sizes)], 2048)
    assert sum(map(len, windows)) == len(sizes)
    assert len(packing.partition([(i, 0, 1100) for i in range(100)], 2048)) <= 55  # lengths that no two of which fit together are cut


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 2048), st.integers(1, 150))
def test_documents_of_one_length_are_cut_in_two_at_most(size, n):
    """Cutting on end tears a document at each window's end; no more documents are torn here, and none into many pieces."""
    windows = packing.partition([(i, 0, size) for i in range(n)], 2048)
    pieces = Counter(d for w in packing.joined(windows) for d, _, _ in w)
    assert sum(pieces.values()) <= n + len(windows)
    assert max(sum(p[2] for p in w) for w in windows) <= 2048


def test_cuts_are_few_where_no_two_documents_fit():
    windows = packing.partition([(i, 0, 1100) for i in range(100)], 2048)
    pieces = Counter(d for w in packing.joined(windows) for d, _, _ in w)
    assert sum(pieces.values()) < 160 and max(pieces.values()) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 512), min_size=1, max_size=120), st.integers(1, 12))
def test_differencing(sizes, windows):
    parts = packing.differencing(sizes, windows)
    assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and len(parts) == windows


def test_long_texts_are_read_in_segments(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 64)
    texts = ["one's two  three\n\n" * 40, "x" * 500, None, "", "漢字 a1 " * 60, " " * 300 + "end", "short"]
    ids, ends = bpe.from_ranks(RANKS).encode_rows(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [ENCODING.encode_ordinary(t or "") for t in texts]


def test_differencing_is_near_equal():
    sizes = [(i * 7919) % 511 + 1 for i in range(100)]
    loads = [sum(sizes[i] for i in p) for p in packing.differencing(sizes, 12)]
    assert max(loads) - min(loads) <= 8


def test_counts_and_cache(spark, frame, tmp_path):
    cache = f"file://{tmp_path}/cache"
    want = {i: len(LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(EDGES)}
    for _ in range(2):
        found = {r["doc_id"]: r for r in token_counts.count_tokens(frame(EDGES), JSON, cache).collect()}
        assert {i: r["n_tokens"] for i, r in found.items()} == want
        assert all(found[i]["n_bytes"] == len((t or "").encode()) for i, t in enumerate(EDGES))
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for t in EDGES})
    token_counts.count_tokens(frame(["new text"]), JSON, cache).collect()
    assert spark.read.parquet(cache).count() == len({t or "" for t in EDGES}) + 1
    assert token_counts.count_tokens(frame([]), JSON, f"{cache}2").count() == 0


def test_doubled_cache_entries_count_once(spark, frame, tmp_path):
    cache = f"file://{tmp_path}/cache"
    want = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(frame(EDGES), JSON, cache).collect()}
    spark.read.parquet(cache).write.mode("append").parquet(f"{cache}-copy")
    spark.read.parquet(f"{cache}-copy").write.mode("append").parquet(cache)
    found = token_counts.count_tokens(frame(EDGES), JSON, cache).collect()
    assert len(found) == len(EDGES) and {r["doc_id"]: r["n_tokens"] for r in found} == want


def test_null_and_repeated_ids_each_give_rows(frame, tmp_path):
    docs = frame(["one", "two two", None, "one"], [None, 3, 3, None])
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in bpe.encode_digests(docs, RANKS).collect()) == sorted((i, len(ENCODING.encode_ordinary(t))) for i, t in [(-1, "one"), (3, "two two"), (3, ""), (-1, "one")])
    assert token_counts.count_tokens(docs, JSON, f"file://{tmp_path}/cache").count() == 4
    assert sum(r["length"] for r in packing.pack(docs, JSON).collect()) == 4 + sum(len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in ("one", "two two", "", "one"))
    assert bpe.encode_digests(frame([]), RANKS).count() == 0


def test_count_query(spark, small, documents):
    found = {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in queries.op8_token_counts(spark, small).collect()}
    want = {r["doc_id"]: len(LIBRARY.encode(r["text"], add_special_tokens=False).ids) for r in documents.collect()}
    assert found == {i: (n, n > 512) for i, n in want.items()}


def test_unknown_file():
    with pytest.raises(FileNotFoundError):
        bpe.from_ranks("/nowhere")
