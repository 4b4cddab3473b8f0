"""Operators 1, 2, 5, 7, 9 and 10 against brute force and held-out accuracy."""

import collections
import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aerolith.llm import fingerprints, graph, language_id, language_model, ngram_trie, queries, repeats, simhash, toxicity
from aerolith.llm.common import id_remainder
from aerolith.llm.hashing import range_hashes

from .conftest import EDGES

WORD = r"[^\x20\x09-\x0D]+"
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- 1: fingerprints ---------------------------------------------------------------------------


def test_parse_is_lempel_ziv():
    ends = array("q")
    fingerprints.parse(b"abababcabc", {}, 0, 0, ends)
    assert ends.tolist() == plain_parse(b"abababcabc") == [1, 2, 4, 7]  # a, b, ab, abc; abc is known and left over


def plain_parse(data):
    known, ends, start = set(), [], 0
    for i in range(1, len(data) + 1):
        if data[start:i] not in known:
            known.add(data[start:i])
            ends.append(i)
            start = i
    return ends


def test_parse_against_plain(documents):
    for r in documents.limit(20).collect():
        data, ends = r["text"].encode(), array("q")
        fingerprints.parse(data, {}, 0, 0, ends)
        assert ends.tolist() == plain_parse(data)


def check_edits(rows, texts):
    order = sorted(texts, reverse=True)
    for i, r in rows.items():
        own, after = texts[i] or "", texts[order[(order.index(i) + 1) % len(order)]] or ""
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints = [fingerprints.Parsed(t).signature for t in (own, edited, after)]
        assert r["fingerprint"] == fingerprints.shown(prints[0]) and r["edited_fingerprint"] == fingerprints.shown(prints[1])
        assert r["near_edited"] == fingerprints.likeness(prints[0], prints[1]) and r["near_next"] == fingerprints.likeness(prints[0], prints[2])


def plain_likeness(a, b):
    """Of the phrases of two texts: the share of common ones among the 64 with the least hashes of both."""
    sets = []
    for data in (a.encode(), b.encode()):
        ends = plain_parse(data)
        ends += [len(data)] if data and (not ends or ends[-1] < len(data)) else []
        sets.append({data[x:y] for x, y in zip([0, *ends], ends)})
    if not any(sets):
        return 1.0
    every = {p: int(range_hashes(np.frombuffer(p, np.uint8), np.array([0]), np.array([len(p)]))[0]) >> 32 for p in sets[0] | sets[1]}
    least = sorted(every, key=every.get)[:64]
    return sum(p in sets[0] and p in sets[1] for p in least) / len(least)


def test_likeness_is_that_of_the_phrase_sets(documents):
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(30).collect()]
    for a, b in zip(texts, [*texts[1:], texts[0]]):
        got = fingerprints.likeness(fingerprints.Parsed(a).signature, fingerprints.Parsed(b).signature)
        assert got == pytest.approx(plain_likeness(a, b), abs=1e-12)


def test_signature_does_not_hang_on_steps(monkeypatch):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(20_000))
    whole = fingerprints.Parsed(text).signature
    monkeypatch.setattr(fingerprints, "STEP", 500)
    assert (fingerprints.Parsed(text).signature == whole).all()


@pytest.mark.parametrize("buckets", [1, 3, 512])
def test_edits(frame, buckets):
    found = {r["doc_id"]: r for r in fingerprints.compare_edits(frame(EDGES), buckets).collect()}
    assert len(found) == len(EDGES)
    check_edits(found, dict(enumerate(EDGES)))
    assert found[8]["fingerprint"] == found[9]["fingerprint"] and found[0]["fingerprint"] == ""


def test_edits_query(spark, small, documents):
    found = {r["doc_id"]: r for r in queries.op1_lz_fingerprints(spark, small).collect()}
    check_edits(found, {r["doc_id"]: r["text"] for r in documents.collect()})


def test_edits_of_odd_tables(frame):
    assert fingerprints.compare_edits(frame([])).count() == 0
    assert fingerprints.compare_edits(frame(["alone"])).first()["near_next"] == 1.0
    assert fingerprints.compare_edits(frame(["a", "b", "b"], [None, 1, 1])).count() == 3


@pytest.mark.parametrize("buckets", [1, 4, 20])
def test_many_rows_of_one_id_fill_many_buckets(frame, buckets):
    """Null and equal ids are split, no id is reserved, and each row still has the next one of one order."""
    texts = [f"text {i} " * (1 + i % 5) for i in range(360)]
    least = -(1 << 63)
    ids = [None] * 150 + [7] * 150 + [least, least + 1, (1 << 63) - 1, (1 << 63) - 2, 1 << 60] + list(range(100, 155))
    docs = frame(texts, ids)
    placed = fingerprints.with_following(docs, buckets).collect()
    own = [r for r in placed if not r["guest"]]
    assert len(own) == 360 and len(placed) - len(own) == len({r["bucket"] for r in own})
    if buckets == 20:
        assert max(Counter(r["bucket"] for r in own).values()) < 60
    order = sorted(own, key=lambda r: (r["id"], r["key"], r["text"]), reverse=True)
    assert order == sorted(order, key=lambda r: -r["bucket"])
    assert all(r["id"] == least and r["key"] < 0 for r in order[-150:])
    following = {r["text"]: order[(i + 1) % 360]["text"] for i, r in enumerate(order)}
    want = []
    for i, own_text in zip(ids, texts):
        edited = own_text[: len(own_text) - len(own_text) // 2] + following[own_text][: len(own_text) // 2]
        want.append((str(i), hashlib.sha256(edited.encode()).hexdigest()))
    found = [(str(r["doc_id"]), r["edited_sha256"]) for r in fingerprints.compare_edits(docs, buckets).collect()]
    assert sorted(found) == sorted(want)


# --- 2: languages ------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark, small, documents):
    found = queries.op2_language_id(spark, small)
    told = found.join(documents, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert told.agg(F.avg("ok")).first()[0] > 0.95
    assert found.count() == documents.count() and found.where("score < 0 or score > 1").count() == 0


def test_undetermined(frame, documents):
    model = language_id.learn(documents, id_remainder(4) != 2)
    found = {r["doc_id"]: r for r in language_id.identify(frame(EDGES).select("doc_id", "text"), model).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (0, 1, 3, 4))
    nothing = language_id.learn(documents.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(frame(["some words"]).select("doc_id", "text"), nothing).collect()} == {"und"}


def test_languages_of_odd_tables(frame, documents):
    model = language_id.learn(documents, id_remainder(4) != 2)
    assert language_id.identify(frame([]), model).count() == 0
    docs = frame(["the same text"] * 3, [None, 5, 5])
    found = language_id.identify(docs.withColumn("lang_pred", F.lit("mine")), model)
    assert found.columns.count("score") == 1 and found.columns.count("lang_pred") == 1 and found.count() == 3
    assert {r["fingerprint"] for r in found.collect()} == {"x"}


def test_ngrams_of_words_count_as_often_as_the_words(frame):
    docs = frame(["aaa aaa aaa bbb", "ccc ddd ddd ddd ddd"]).withColumn("lang", F.when(F.col("doc_id") == 0, "p").otherwise("q"))
    model = language_id.learn(docs, F.lit(True))
    at_p, at_q = model.languages.index("p"), model.languages.index("q")
    totals = [sum(3 if w in ("aaa",) else 1 for w in ("aaa", "bbb") for _ in language_id.ngrams(w)), 0]
    share = lambda gram, at: math.exp(model.grams[gram][at])
    assert share("a", at_p) / share("b", at_p) == pytest.approx((9 + 0.1) / (3 + 0.1)) and share("d", at_q) > share("c", at_q) and totals[0] > 0


def test_predictions_are_those_of_plain_counts(spark, small, documents):
    """Words by their log frequencies, unknown ones by the longest known n-gram at each position; no word is too rare to count."""
    rows = documents.select("doc_id", "text", "lang").collect()
    learnt = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None]
    words, grams = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for r in learnt:
        words[r["lang"]].update(language_id.WORD.findall((r["text"] or "").lower()))
    langs = sorted(k for k, c in words.items() if c)
    for k in langs:
        for w, n in words[k].items():
            for g in language_id.ngrams(w):
                grams[k][g] += n
    known_words, known_grams = set().union(*words.values()), set().union(*grams.values())
    share = lambda table, known, f: np.array([math.log((table[k][f] + 0.1) / (sum(table[k].values()) + 0.1 * (len(known) + 1))) for k in langs])
    held = {}

    def of_word(w):
        if w not in held:
            marked = f" {w} "
            longest = lambda i: next((marked[i : i + n] for n in (4, 3, 2, 1) if i + n <= len(marked) and marked[i : i + n] in known_grams), None)
            found = [longest(i) for i in range(len(marked))]
            held[w] = share(words, known_words, w) if w in known_words else sum((share(grams, known_grams, g) for g in found if g), np.zeros(len(langs))) / len(marked)
        return held[w]

    got = {r["doc_id"]: r for r in queries.op2_language_id(spark, small).collect()}
    for r in rows:
        found = language_id.WORD.findall((r["text"] or "").lower())
        if not found:
            assert got[r["doc_id"]]["lang_pred"] == "und" and got[r["doc_id"]]["score"] == 0
            continue
        sums = sum(of_word(w) for w in found)
        assert got[r["doc_id"]]["lang_pred"] == langs[int(np.argmax(sums))]
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / np.exp(sums - sums.max()).sum(), rel=1e-6)


# --- 5: language model -------------------------------------------------------------------------


def check_model(rows, texts):
    words = {i: re.findall(WORD, lower(t)) + ["<end>"] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert rows[i]["n_tokens"] == len(ws) and rows[i]["train_tokens"] == n and rows[i]["n_known"] == sum(counts[w] > 0 for w in ws)
        assert rows[i]["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9) and rows[i]["score"] <= 1e-9


@pytest.mark.parametrize("shard_bytes", [40_000, 1 << 23])
def test_model(documents, shard_bytes):
    found = {r["doc_id"]: r for r in language_model.score(documents, id_remainder(10) != 0, shard_bytes).collect()}
    check_model(found, {r["doc_id"]: r["text"] for r in documents.collect()})
    held = [r for i, r in found.items() if zlib.crc32(str(i).encode()) % 10 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_scores(texts, trained):
    """The model of texts in plain counts, its shares and masses after two words in the trie's eight bits."""
    code = lambda p: language_model.probability(language_model.quantise(np.array([p])))[0]
    sentences = {i: ["<begin>", *re.findall(WORD, lower(t)), "<end>"] for i, t in texts.items()}
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for i in trained:
        s = sentences[i]
        one.update(s[1:])
        two.update(zip(s, s[1:]))
        three.update(zip(s, s[1:], s[2:]))
    n, v = sum(one.values()), len(one)
    total, kinds = collections.Counter({"<begin>": len(trained)}) + one, collections.Counter(a for a, _ in two)
    kinds2 = collections.Counter((a, b) for a, b, _ in three)
    out = {}
    for i, s in sentences.items():
        out[i] = 0.0
        for at in range(1, len(s)):
            w, a = s[at], s[at - 1]
            p = (one[w] - 0.75) / n if one[w] else 0.75 * v / n
            if total[a] and a != "<end>":
                p = min(1, 0.8 * max(kinds[a], 1) / total[a]) * p + (code((two[a, w] - 0.8) / total[a]) if two[a, w] else 0)
            pair = (s[at - 2], a) if at > 1 else None
            if two[pair]:
                p = code(0.8 * kinds2[pair] / two[pair]) * p + (code((three[*pair, w] - 0.8) / two[pair]) if three[*pair, w] else 0)
            out[i] += math.log10(p)
    return out


@pytest.mark.parametrize("shard_bytes", [40_000, 1 << 23])
def test_scores_are_those_of_plain_counts(documents, shard_bytes):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    want = plain_scores(texts, [i for i in texts if zlib.crc32(str(i).encode()) % 10])
    found = {r["doc_id"]: r["score"] for r in language_model.score(documents, id_remainder(10) != 0, shard_bytes).collect()}
    assert found == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("shard_bytes", [2_000, 1 << 23])
def test_scores_with_frequent_pairs(frame, shard_bytes):
    """Frequent words and pairs are dealt by what follows them; scores don't hang on it."""
    texts = [" ".join(f"of the w{(i * 40 + j) % 700} a" for j in range(40)) for i in range(60)] + ["of the new", "the w1 of", "", "of", "of the", "a of the w3"]
    trained = [*range(60), 62, 64]
    found = {r["doc_id"]: r["score"] for r in language_model.score(frame(texts), F.col("doc_id").isin(trained), shard_bytes).collect()}
    assert found == pytest.approx(plain_scores(dict(enumerate(texts)), trained), rel=1e-9)


@pytest.mark.parametrize("shard_bytes", [1_000, 4_000, 1 << 23])
def test_back_off_of_a_frequent_word(frame, shard_bytes):
    """The mass that a word with many continuations gives up doesn't hang on the number of shards."""
    follow = [f"w{i % 2000}" for i in range(3000)]
    texts = [" ".join(f"the {w}" for w in follow[i : i + 50]) for i in range(0, 3000, 50)] + ["solo", "the solo"]
    ids = list(range(len(texts)))
    found = {r["doc_id"]: r for r in language_model.score(frame(texts, ids), F.col("doc_id") != ids[-1], shard_bytes).collect()}
    ends = len(texts) - 1
    n, v, kinds = 6000 + 1 + ends, 2000 + 3, 2000
    unigram = lambda c: (c - 0.75) / n
    begin = language_model.probability(language_model.quantise(np.array([(60 - 0.8) / ends])))[0] + 0.8 * 2 / ends * unigram(3000)
    back = language_model.probability(language_model.quantise(np.array([0.8 * 40 / 60])))[0]  # 40 words follow the first "the" of 60 texts
    want = math.log10(begin) + math.log10(back * 0.8 * kinds / 3000 * unigram(1))
    end = language_model.probability(language_model.quantise(np.array([(1 - 0.8) / 1])))[0] + 0.8 * unigram(ends)
    assert v == 2003 and found[ids[-1]]["score"] == pytest.approx(want + math.log10(end), rel=1e-9)


def test_first_words_are_spread_over_buckets(frame, monkeypatch):
    asked, answer = [], language_model.answer
    monkeypatch.setattr(language_model, "answer", lambda questions, *rest: asked.append(questions) or answer(questions, *rest))
    texts = [f"first{i} word" for i in range(400)]
    language_model.score(frame(texts), F.lit(True), 800)
    holding = {r["bucket"] for r in asked[0].collect() if language_model.BEGIN in np.frombuffer(r["contexts"], np.uint64)}
    assert len(holding) > 5


def test_regular_long_words_are_told_apart(frame):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2^64 in any base."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    found = {r["doc_id"]: r["n_known"] for r in language_model.score(frame([word, other]), F.col("doc_id") == 0).collect()}
    assert found == {0: 2, 1: 1}


def test_model_of_odd_texts(frame):
    found = {r["doc_id"]: r for r in language_model.score(frame(EDGES), id_remainder(10) != 0).collect()}
    check_model(found, dict(enumerate(EDGES)))
    assert language_model.score(frame([]), F.lit(True)).count() == 0
    assert language_model.score(frame(["a b"]), F.lit(False)).first()["score"] == 0


def test_elias_fano_and_trie():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 50, 5000, dtype=np.uint64))
    reader = ngram_trie.Reader(ngram_trie.EliasFano.encode(values, 1 << 50))
    assert (reader[np.arange(len(values))] == values).all()
    asked = rng.integers(0, 1 << 50, 300, dtype=np.uint64)
    whole = np.zeros(300, np.int64), np.full(300, len(values))
    assert (reader.successor(asked, *whole) == np.searchsorted(values, asked)).all()
    contexts = np.array([5, 9, 1 << 60], np.uint64)
    seconds = np.array([0, 2, 3]), np.array([7, 8, 7, 1], np.uint64)
    thirds = np.array([0, 1, 1, 4]), np.array([5, 2, 5, 6, 9], np.uint64)
    trie = ngram_trie.Trie(contexts, [seconds, thirds], {"codes": np.arange(1, 5, dtype=np.uint8)})
    assert trie.find_contexts(np.array([9, 6, 1 << 60], np.uint64)).tolist() == [1, -1, 2]
    assert trie.find(0, np.array([0, 0, 1, -1, 2, 1]), np.array([8, 9, 7, 7, 1, 8], np.uint64)).tolist() == [1, -1, 2, -1, 3, -1]
    assert trie.find(1, np.array([0, 1, 2, 2, 3, -1]), np.array([5, 2, 5, 9, 9, 9], np.uint64)).tolist() == [0, -1, 2, -1, 4, -1]
    assert trie.fields["codes"].tolist() == [1, 2, 3, 4]
    p = np.array([1.0, 0.3, 1e-9])
    assert (ngram_trie.probability(ngram_trie.quantise(p)) <= p * (1 + 1e-9)).all()


# --- 7: toxicity -------------------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op7_toxicity(spark, sf).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    assert sum(r["toxic"] == r["predicted"] for r in rows) / len(rows) > 0.9
    toxic, clean = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    assert sum(a > b for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.6


def test_disguises_and_odd_texts(spark, frame):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"), id_remainder(3) != 1)
    for text in ("1d10t", "st*pid", "m0r0n!", "idiooot", "i d i o t", "s.c.u.m"):
        assert model.count(text, {}) == 1, text
    assert model.count("the clean words are here 123 a b c", {}) == 0
    scores = [r["score"] for r in toxicity.score(frame(EDGES).select("doc_id", "text"), model).collect()]
    assert len(scores) == len(EDGES) and all(0 <= s < 0.7 for s in scores)
    nothing = toxicity.learn(docs.limit(0), spark.read.parquet(f"{sf}/labels.parquet").limit(0), F.lit(True))
    assert toxicity.score(frame(["x"]).select("doc_id", "text"), nothing).first()["score"] == 0.5


@pytest.fixture(scope="module")
def toxicity_model(spark):
    sf = "/root/testdata/sf0.01"
    return toxicity.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), id_remainder(3) != 1)


def test_viterbi_is_the_best_reading(toxicity_model):
    """Against all readings of the lattice, one by one."""
    model = toxicity_model.characters
    for word in ("1d10t", "st*pid", "m0r0n", "idiooot", "s.c.u.m", "h3||o", "c00l", "a+b"):
        found = []

        def read(i, text, context, cost, leaving, word=word, found=found):
            if i == len(word):
                found.append((cost - model.log_probability(context, " "), text))
                return
            for to, letters, extra in leaving[i]:
                own, now = cost + extra, context
                for x in letters:
                    own -= model.log_probability(now, x)
                    now = (now + x)[-(toxicity.ORDER - 1) :]
                read(to, text + letters, now, own, leaving)

        read(0, "", " " * (toxicity.ORDER - 1), 0.0, toxicity.arcs(word))
        assert toxicity.viterbi(word, model) == min(found)[1], word


def test_spacing_accents_and_look_alikes(toxicity_model):
    for text in ("i  d  i  o  t", "i\nd\ni\no\nt", "ídïöt", "іdіоt", "IDIÓT", "y o u  a r e  a n  i d i o t"):
        assert toxicity_model.count(text, {}) >= 1, text
    for text in ("élève à l'école", "größer und schöner", "москва", "a  b\nc"):
        assert toxicity_model.count(text, {}) == 0, text


def test_scores_rise_with_marks_and_odds(frame, toxicity_model):
    words = sorted((f[1:] for f in toxicity_model.marks if f[0] == "="), key=lambda w: toxicity_model.marked(w))
    texts = ["clean text", words[0], words[-1], f"{words[0]} {words[0]}", f"{words[-1]} {words[-1]}"]
    docs = frame(texts, [None, 1, 1, 2, 3]).withColumn("odds", F.lit("mine"))
    found = toxicity.score(docs, toxicity_model)
    assert found.columns.count("score") == 1 and found.columns.count("odds") == 1
    by = {(r["marks"], round(r["odds"], 9)): r["score"] for r in found.collect()}
    ranked = [by[k] for k in sorted(by)]
    assert ranked == sorted(ranked) and len(ranked) >= 3 and all(0 <= x <= 1 for x in ranked)
    assert toxicity.score(frame([]), toxicity_model).count() == 0


def test_copies_agree_and_others_do_not():
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 1 << 30, 300)]
    shared = [f"s{i}" for i in range(60)]
    assert toxicity.signature(" ".join(base)) == toxicity.signature(" ".join(base).upper())
    others = {toxicity.signature(" ".join(shared + [f"w{i}" for i in rng.integers(0, 1 << 30, 200)])) for _ in range(50)}
    assert len(others) >= 45  # a fifth of their pairs of words is common


def test_long_and_joined_disguises(toxicity_model):
    spaced = "y o u a r e a n i d i o t a n d m o r e"
    for text in (spaced, " ".join([spaced] * 3), " ".join([spaced] * 40), "1d1" + "o" * 50 + "7", "y.o.u.a.r.e.a.n.i.d.i.o.t.a.n.d.m.o.r.e", "a i d i o t", "-".join("you are an idiot and much more of this".replace(" ", ""))):
        assert toxicity_model.count(text, {}) >= 1, text
    assert toxicity_model.count(" ".join([spaced] * 40), {}) >= 30  # windows lose next to nothing
    for text in ("t h e w e a t h e r i s v e r y n i c e t o d a y", "https://www.example.org/some/long/path/of-words-2024/page-17.html", "x1" * 30_000, "ab-" * 20_000):
        assert toxicity_model.count(text, {}) == 0, text[:60]


def test_keys_lose_no_mark(toxicity_model):
    """With and without the look at keys: disguises of every kind in and around marked words, and others."""
    rng = random.Random(3)
    model = toxicity.Model(toxicity_model.marks, toxicity_model.characters, toxicity_model.shares)
    plain_model = toxicity.Model(model.marks, model.characters, model.shares)
    plain_model.may_be_marked = lambda word: True
    marked = sorted(f[1:] for f in model.marks)
    back = {"o": "0", "i": "1!|*", "l": "1|£", "e": "3€*", "a": "4@*", "s": "5$", "t": "7+", "g": "69", "b": "8", "c": "(", "z": "2"}
    n_marked = 0
    for i in range(3000):
        word = rng.choice(["", "xq", "un"]) + rng.choice(marked) + rng.choice(["", "", "ly", "rr"]) if i % 3 else "".join(rng.choices("idotscum105.-$!", k=rng.randrange(1, 50)))
        word = "".join(rng.choice(back[c]) if c in back and rng.random() < 0.2 else c * rng.choice([1, 1, 1, 2, 4]) + rng.choice(["", "", "", "", ".", "-", "_"]) for c in word)
        word = rng.choice(["", "", "(", "$", "«", "**"]) + word + rng.choice(["", "", "!", "!!", ",", "***", "$"])
        assert model.toxic_word(word) == plain_model.toxic_word(word), word
        n_marked += model.toxic_word(word) > 0
    assert n_marked > 300


def test_screen_loses_no_word(toxicity_model):
    """Many texts at once against each word by itself, without any look at keys; with learnt marks, odd ones and none."""
    rng = random.Random(8)
    learnt = toxicity_model.marks
    odd = {"=i": 4.0, "=vv": 5.0, "<aaaa": 4.5, ">ßenß": 4.2, "=жук": 6.0, "<жжжу": 4.1, "=\U0001d41f\U0001d42e": 5.5, "=ﬁn": 4.3, ">élan": 4.4, "=100": 4.6, ">00m0": 4.7, "=東京": 5.1}
    words = [f[1:] for f in [*learnt, *odd]]
    signs = "abio1e0sé ßжукßöﬁ東京½²™¨i\u0307ı\u0301$!(*.-_'«\U0001d41f\u00ad"
    for marks in (learnt, learnt | odd, {"<----": 4.0, "=idiot": 5.0}, {}):
        model = toxicity.Model(marks, toxicity_model.characters, toxicity_model.shares)
        plain_model = toxicity.Model(marks, toxicity_model.characters, toxicity_model.shares)
        plain_model.may_be_marked = lambda word: True
        texts = ["", " ", "\n\x1c", "a", "a b", "ab c", "c. d_"]
        for _ in range(300):
            some = [rng.choice(["", "un", "x"]) + rng.choice(words) + rng.choice(["", "ly", "!", ".", "--", "é"]) if rng.random() < 0.4 else "".join(rng.choices(signs, k=rng.choice([1, 1, 2, 3, 5, 9, 45]))) for _ in range(rng.randrange(12))]
            texts.append("".join(w + rng.choice([" ", "  ", "\n", "\u00a0", "\x1c"]) for w in some))
        left, spaced = model.screen.left([t.lower() for t in texts])
        for text, own, letters in zip(texts, left, spaced):
            every = text.lower().split()
            marked = [w for w in every if plain_model.toxic_word(w)]
            assert [w for w in own if model.toxic_word(w)] == marked, text
            single = "".join("s" if len(w) < 3 and (len(w) == 1 or w[1] in ".-_*") else " " for w in every)
            assert letters == ("ss" in single), text
        assert model.found(texts, {}) == [model.found([t], {})[0] for t in texts]
    assert model.found([], {}) == []


def test_screen_spares_most_words(toxicity_model):
    """A word by itself costs so much that only those that may be marked are looked at."""
    rng = random.Random(4)
    model = toxicity.Model(toxicity_model.marks, toxicity_model.characters, toxicity_model.shares)
    asked, own = [], model.toxic_word
    model.toxic_word = lambda word: asked.append(word) or own(word)
    text = " ".join("".join(rng.choices("aeionrtéöи", k=rng.randrange(2, 12))) + rng.choice(["", "", ".", ","]) for _ in range(5000)) + " idiot"
    assert model.count(text, {}) >= 1
    assert "idiot" in asked and len(asked) < 250


def test_every_label_teaches_toxicity(spark, frame):
    """Each of more labelled texts than the sample of an earlier version held changes counts and shares; documents without a
    training label change nothing."""
    n = 12_000
    docs = spark.range(2 * n).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 8 == 0, "grobword zzqa").otherwise("fair day"), F.lit(" a"), F.col("id").cast("string"), F.lit(" b"), (F.col("id") * 7).cast("string")).alias("text"))
    labels = docs.where(F.col("doc_id") < n).select("doc_id", (F.col("doc_id") % 8 == 0).cast("int").alias("toxic"))
    model = toxicity.learn(docs, labels, F.lit(True))
    toxic, clean = n // 8, n - n // 8
    assert model.marks["=grobword"] == pytest.approx(math.log(((toxic + 0.5) / (toxic + 1)) / (0.5 / (clean + 1))))
    assert model.characters.counts["grob"[:3]] == toxic and model.characters.counts[" fa"] == clean
    assert model.shares[0] == pytest.approx(0.5 / (clean + 1)) and model.shares[2] == pytest.approx((toxic + 0.5) / (toxic + 1))


# --- 9: near-duplicates ------------------------------------------------------------------------


def plain_simhash(text):
    words = re.findall(WORD, lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    parent = {f: f for f in set(fps.values())}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = list(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for i, f in fps.items():
        least[find(f)] = min(least.get(find(f), i), i)
    return {i: least[find(f)] for i, f in fps.items()}


def check_groups(rows, texts):
    fps = {i: plain_simhash(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in rows.items()} == plain_groups(fps)


def test_near_duplicates_query(spark, small, documents):
    check_groups({r["doc_id"]: r for r in queries.op9_simhash(spark, small).collect()}, {r["doc_id"]: r["text"] for r in documents.collect()})


def test_near_duplicates_of_odd_texts(frame):
    check_groups({r["doc_id"]: r for r in simhash.near_duplicates(frame(EDGES)).collect()}, dict(enumerate(EDGES)))
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.near_duplicates(frame(["a", "a"], [7, 7])).count() == 2


def test_masks_cover_every_difference():
    rng = np.random.default_rng(2)
    masks = simhash.covering_masks(list(range(64)))
    finer = simhash.refine(masks[3])
    free = [p for p in range(64) if not masks[3] >> p & 1]
    for _ in range(3000):
        for positions, family in ((range(64), masks), (free, finer)):
            differing = sum(1 << int(p) for p in rng.choice(list(positions), 3, replace=False))
            assert any(not m & differing for m in family)


def test_large_buckets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    seeds = [0, (1 << 63) + 5, 12345678901234567]
    fps = {s ^ sum(1 << int(p) for p in rng.choice(24, rng.integers(0, 7), replace=False)) for s in seeds for _ in range(60)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    for limit in (8, 1024):
        links = simhash.links_within_radius(df, limit)
        roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
        found, want = collections.defaultdict(set), collections.defaultdict(set)
        for i, g in plain_groups({simhash.signed(f): f for f in fps}).items():
            want[g].add(i)
            found[roots.get(i, i)].add(i)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert all(roots[i] == 0 for i in range(1, 51)) and roots[101] == 100


# --- 10: repeats -------------------------------------------------------------------------------


def plain_removal(texts, length=200):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    counts = collections.Counter(b[p : p + length] for b in raw.values() for p in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def found_removal(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()}


@pytest.mark.parametrize("shard_bytes", [30_000, 1 << 23])
def test_repeats(documents, shard_bytes):
    docs = documents.select("doc_id", "text")
    assert found_removal(repeats.removal(docs, shard_bytes=shard_bytes)) == plain_removal({r["doc_id"]: r["text"] for r in docs.collect()})


def test_repeats_of_odd_texts(frame, monkeypatch):
    passage = "".join(chr(97 + i * i % 26) for i in range(260))
    texts = [*(t for t in EDGES if t is None or len(t) < 100), "a" * 500, f"one {passage} two", f"three {passage[:230]} four", passage[:200], passage[1:201], "é" * 150 + passage]
    got = found_removal(repeats.removal(frame(texts).select("doc_id", "text")))
    assert got == plain_removal(dict(enumerate(texts)))
    assert repeats.removal(frame([]).select("doc_id", "text")).count() == 0


def test_repeats_beside_clashing_columns(frame):
    """Columns named like the operator's outputs give way, others stay; null and repeated ids each give a row."""
    passage = "".join(chr(97 + i * i % 26) for i in range(260))
    docs = frame([passage, f"a {passage}", passage, None], [None, 7, 7, None]).withColumns({"kept": F.lit(1), "n_bytes": F.lit("x"), "bucket": F.lit(2), "kind": F.lit(3)})
    found = repeats.removal(docs)
    assert found.columns == [*(c for c in docs.columns if c not in ("text", "kept", "n_bytes")), "n_bytes", "n_removed", "n_spans", "kept"]
    rows = found.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["7", "7", "None", "None"] and {r["shard"] for r in rows} == {"y"}
    assert sorted(bytes(r["kept"]) for r in rows) == [b"", b"", b"", b"a "]


def test_repeats_in_long_rows():
    from aerolith.llm.shards import segments

    offsets = np.array([0, 10, 10, 95, 100])
    chunks = list(segments(offsets, 4, 30))
    starts = [p for chunk in chunks for a, b in chunk for p in range(a, b - 4)]
    assert sorted(starts) == [p for a, b in zip(offsets[:-1], offsets[1:]) for p in range(a, b - 4)]


def test_repeats_query(spark, small, documents):
    want = plain_removal({r["doc_id"]: r["text"] for r in documents.collect()})
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op10_repeats(spark, small).collect()}
    assert found == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in want.items()}
