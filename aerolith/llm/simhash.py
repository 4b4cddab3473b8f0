"""Operator 9: SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position is given a non-zero vector of RADIUS + 1 bits; table v keeps the positions whose
vector has odd product with v. The at most RADIUS positions in which two linked fingerprints differ
have vectors that some non-zero v is orthogonal to, so table v keeps none of them, and the two
collide there: no link is lost. Distinct fingerprints only are hashed, so exact copies cost nothing.

A bucket that holds more than LIMIT distinct fingerprints is covered anew on the bits that its mask
leaves free, which again loses no link; two such rounds leave so few free bits that no bucket can be
larger. Each bucket yields a spanning forest of its links, not its pairs; star contraction joins
the forests to components.

Null and empty texts have fingerprint zero. Null ids never become component ids unless a component
has no other. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, forget, materialise, ship_package, whole_text
from aerolith.llm.graph import components

RADIUS, BITS, LIMIT, SHINGLE = 3, 64, 1024, 3


def text_simhash(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.append(0, ends[:-1] + 1)
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        set_bits += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            fps = np.array([text_simhash(t.as_py(), shingle) for t in column(batch, "text")], np.uint64)
            yield pa.record_batch([column(batch, "doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(free: list[int], radius: int = RADIUS, fixed: int = 0) -> list[int]:
    """The masks that cover all differences of at most radius free bits, each with the fixed bits."""
    vectors = (1 << (radius + 1)) - 1
    return [fixed | sum(1 << p for k, p in enumerate(free) if ((k % vectors + 1) & v).bit_count() & 1) for v in range(1, vectors + 1)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def refine(mask: int) -> list[int]:
    return covering_masks([p for p in range(BITS) if not mask >> p & 1], fixed=mask)


def forest(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect the same fingerprints as all links within the radius do: each to one already reached."""
    left = np.ones(len(fps), bool)
    out = []
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            x = todo.pop()
            near = np.flatnonzero(left & (np.bitwise_count(fps ^ fps[x]) <= radius))
            left[near] = False
            todo.extend(near.tolist())
            out.extend((root, n) for n in near.tolist())
    return out


def bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of runs of equal (mask, key) in sorted rows."""
    held = None
    names = ("mask", "key", "fp")

    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        a, b = [], []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
            if hi - lo == 2:
                if (int(fp[lo]) ^ int(fp[lo + 1])).bit_count() <= RADIUS:
                    a.append(fp[lo])
                    b.append(fp[lo + 1])
            elif hi - lo > 2:
                for x, y in forest(fp[lo:hi]):
                    a.append(fp[lo + x])
                    b.append(fp[lo + y])
        return pa.record_batch([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        cols = [np.asarray(column(batch, c)) for c in names]
        cols[2] = cols[2].view(np.uint64)
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        held = [c[cut:] for c in cols]
        if cut:
            yield links(*(c[:cut] for c in cols))
    if held is not None:
        yield links(*held)


def links_within_radius(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints fp as all links within the radius do."""
    masks = covering_masks(list(range(BITS)))
    rows = fps.select(F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"), "fp")
    out = None
    while masks:
        keyed = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")
        sizes = materialise(keyed.groupBy("mask", "key").count().where("count > 1"))
        fit = keyed.join(sizes.where(F.col("count") <= limit), ["mask", "key"]).select("mask", "key", "fp")
        links = fit.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(bucket_links, "a long, b long")
        out = links if out is None else out.union(links)
        large = sizes.where(F.col("count") > limit)
        hot = {r["mask"] for r in large.select("mask").distinct().collect()}  # at most as many as there are masks
        masks = [m for m in masks if signed(m) in hot]
        if masks:
            finer = {m: refine(m) for m in masks}
            children = F.create_map(*[x for m in masks for x in (F.lit(signed(m)), F.array(*[F.lit(signed(c)) for c in finer[m]]))])
            rows = keyed.join(large.select("mask", "key"), ["mask", "key"]).select(F.explode(children[F.col("mask")]).alias("mask"), "fp").distinct()
            masks = sorted({c for cs in finer.values() for c in cs})
    return out


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint, component_id (the smallest doc_id reachable by links) of every document."""
    fps = materialise(fingerprints(docs, shingle))
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links_within_radius(distinct.select("fp")))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")
