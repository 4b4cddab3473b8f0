"""Operators 11 to 13 against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import hard_negatives, merkle, queries, super_kmers
from aerolith.llm.common import id_remainder
from tests.llm.conftest import EDGES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Operator 12


def leaf(row, text):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append(levels([leaf(r, r.text) for r in groups[name]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for g, (name, tree) in enumerate(zip(names, trees)):
        for i, r in enumerate(groups[name]):
            even = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 2 == 0
            folded, proof = leaf(r, r.text.replace("\n", "") if even and r.text is not None else r.text), ""
            for built, at in ((tree, i), (top, g)):
                for level in built[:-1]:
                    run = at // 3 * 3
                    before, after = "".join(level[run:at]), "".join(level[at + 1 : run + 3])
                    folded, proof, at = sha(before + folded + after), proof + before + after, at // 3
            out.append((r.doc_id, tree[0][i], tree[-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def verified(docs):
    changed = F.when(id_remainder(2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    shown = merkle.verify(docs, changed).select("id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256), "folded_root", "verified")
    return sorted(map(tuple, shown.collect()), key=repr)


def test_manifest_of_documents(documents):
    found = verified(documents)
    assert found == plain_manifest(documents.collect())
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_manifest_of_odd_rows(spark):
    """Null ids, sources and texts, repeated rows and ids, lone leaves, a hot source, clashing names."""
    rows = [(None, "a\nb", "en", None, 3), (None, None, None, None, None), (1, "x\n", "de", "s", 2), (1, "x\n", "de", "s", 2), (1, "y", "de", "s", 1), (-5, "", "de", "é", 0), (7, "z" * 100_000 + "\n", "en", "t", 0)]
    rows += [(i, f"t{i}\n", "en", "hot", 3) for i in range(100)]
    docs = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, pos int, tree string, leaf string")
    assert verified(docs) == plain_manifest(docs.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_manifest_of_any_height(spark, n):
    docs = spark.createDataFrame([(i, "a\n", "en", "s", 2) for i in range(n)], "doc_id long, text string, lang string, source string, n_chars long")
    assert verified(docs) == plain_manifest(docs.collect())


def test_climb_by_single_levels(spark):
    docs = spark.createDataFrame([(i, f"s{i % 5}", sha(str(i))) for i in range(60)], "id long, grp string, leaf string").withColumn("shown", F.lit(None).cast("string"))
    one, three = (merkle.proofs(merkle.build(docs, "grp", "id", "leaf", "shown", stride)) for stride in (1, 3))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, three.collect()))


# Operator 13


def plain_removal(rows, window=20):
    """rows: (id, text), ids unique."""
    seen, out = set(), []
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            own = tuple(words[p : p + window])
            if own in seen:
                gone[p : p + window] = [True] * window
            seen.add(own)
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out)


def removed(docs, **kw):
    return sorted(map(tuple, super_kmers.removal(docs.select("doc_id", "text"), **kw).collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"shard_bytes": 20_000}, {"shard_bytes": 20_000, "crowd": 1}])
def test_windows_of_documents(documents, kw):
    """One shard, several, and several where all shared minimisers are crowded."""
    assert removed(documents, **kw) == sorted(plain_removal([(r.doc_id, r.text) for r in documents.collect()]), key=repr)


@pytest.mark.parametrize("window, gram, crowd", [(20, 6, 4096), (5, 2, 1), (3, 3, 2), (4, 1, 2)])
def test_windows_of_few_words(spark, window, gram, crowd):
    rnd = random.Random(window)
    rows = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(90)))) for i in range(80)]
    rows += [(200, "w " * 3000), (-3, "w\t\n" * 50 + "x"), (201, None), (202, ""), (203, " \n"), (204, "é漢 " * 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(docs, window=window, gram=gram, crowd=crowd, shard_bytes=500) == sorted(plain_removal(rows, window), key=repr)


def test_windows_of_equal_and_null_ids(spark):
    """Null ids come first; of rows alike in id and text one stays; of rows alike in id one text's windows are first."""
    docs = spark.createDataFrame([(None, "q " * 30), (None, "q " * 30), (3, "q " * 30), (-(2**63), "z " * 25), (3, "z " * 25), (4, "a " * 19)], "doc_id long, text string")
    found = removed(docs, shard_bytes=20)
    # The first "q" text keeps its first window's first word: later windows start later in the same text.
    assert sorted(x[2] for x in found if x[1] == 30) == [29, 30, 30] and [x[0] for x in found if x[1] == 30 and x[2] == 29] == [None]
    assert {(x[0], x[2]) for x in found if x[1] == 25} == {(-(2**63), 24), (3, 25)}
    assert [x[2:] for x in found if x[0] == 4] == [(0, " ".join("a" * 19))]


def test_windows_of_edges_and_other_columns(frame):
    docs = frame(EDGES)
    found = super_kmers.removal(docs)
    assert set(found.columns) == {*docs.columns, "n_words", "n_removed", "kept"} - {"text"}
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept").collect())) == plain_removal(list(enumerate(EDGES)))
    assert removed(docs.where("false")) == []


# Operator 11


@pytest.mark.parametrize("size, length", [(1, 1), (511, 64), (10**6, 64), (5 * 10**8, 3), (1000, 200), (2**30, 3)])
def test_products_by_residues(size, length):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (9, length)) for _ in range(2))
    a[0], b[0], b[1] = size, size, -size
    wanted = [[sum(x * y for x, y in zip(r, s)) for s in b.tolist()] for r in a.tolist()]
    assert hard_negatives.Multiplier(a, size * size * length)(b).tolist() == wanted


def test_too_large_scores_are_refused():
    with pytest.raises(ValueError):
        hard_negatives.primes(1 << 62)


def plain_mining(rows):
    """rows: (id, label, vector) of usable rows."""
    out = []
    for i, label, v in rows:
        if i % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in rows if j != i and len(w) == len(v))
            for ps, p, _ in [x for x in scored if x[2] == label][:5]:
                own = [(n, -ns) for ns, n, other in scored if other != label and -30 * ps <= -100 * ns <= -90 * ps][:10]
                out += [(i, p, r, n, -ps, ns) for r, (n, ns) in enumerate(own, 1)]
    return sorted(out)


def mined(df, **kw):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()))


@pytest.mark.parametrize("block", [1, 2, 2048])
def test_mining_of_few_values(spark, block):
    """Ties, negative and zero scores, several lengths, blocks of anchors."""
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 4) for _ in range(4 if i % 11 else 6)]) for i in range(-200, 500)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    assert mined(df, block=block) == plain_mining(rows)


def test_mining_leaves_out_what_takes_no_part(spark):
    good = [(i, i % 2, [i % 5 - 2, 3]) for i in range(150)]
    bad = [(200, None, [9, 9]), (300, 1, None), (None, 1, [9, 9])]
    df = spark.createDataFrame([(*r, "x") for r in good + bad + [(7, 1, [50, 50])]], "vec_id long, label int, vector array<long>, slot string")
    assert mined(df) == plain_mining(good)  # of two rows with id 7 the least vector stands for both
    assert mined(df.where("false")) == []


def test_mining_query(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    usable = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(x))) for x in r.embedding]) for r in rows]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, small).collect())) == plain_mining(usable)
