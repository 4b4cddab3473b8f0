"""Operator 11: hard-negative mining with exact scores from products modulo small primes.

Whole-number vectors are reduced modulo a few primes below 1024. Residues between -511 and 511 multiply exactly in float32
as long as a sum has at most DEPTH terms (511^2 * 64 < 2^24), so each prime costs fast float32 matrix products over slices
of DEPTH components; Chinese remaindering puts the exact signed score together. As many primes are taken as the data's
greatest possible score needs.

Anchors come in blocks of at most BLOCK rows, which are broadcast: a block's size is bounded by that number and the
vectors' length, whatever the table's size. Every task reads its part of the table once for each block and step, and keeps the
best k of each group, so that vectors are never shuffled and few rows are: first each anchor's best rows of its own label
(its positives), then, for each anchor and positive, the best rows of other labels whose scores lie in the window that the
positive's score sets. Rows under a group's current k-th score are passed by.

Rows whose id, label or vector is null, or whose vector is empty or holds null or non-finite components, take no part; vectors of
another length than the anchor's aren't its candidates. Of rows with equal ids, the least (vector, label) stands for all.
Ties go to the smaller id. Vectors whose scores could pass 2^62 are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import column, materialise, ship_package

BLOCK, CHUNK, DEPTH = 2_048, 1_024, 64
NONE, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@lru_cache(None)
def primes(bound: int) -> tuple[int, ...]:
    """Primes below 1024, from the greatest on, whose product is over 2 * bound."""
    if bound >= 1 << 62:
        raise ValueError("the vectors' scores could pass 2^62")
    out, product = [], 1
    for p in (x for x in range(1023, 2, -2) if all(x % d for d in range(3, 32, 2) if d < x)):
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    return tuple(out)


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, nearest to 0, as float32."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def reconstructed(parts: list[np.ndarray], moduli: tuple[int, ...]) -> np.ndarray:
    """The number nearest to 0 with these remainders, by mixed radix digits. Sums wrap modulo 2^64, which the result doesn't
    reach; the sign follows from the digits."""
    digits, weights, weight = [], [], 1
    for r, p in zip(parts, moduli):
        known = sum((d * (w % p) for d, w in zip(digits, weights)), np.zeros_like(r))
        digits.append((r - known) % p * pow(weight, -1, p) % p)
        weights.append(weight)
        weight *= p
    negative = np.zeros(parts[0].shape, bool)
    for d, p in zip(digits, moduli):
        negative = (d > p // 2) | ((d == p // 2) & negative)  # half the product has the digits p // 2
    wrapped = lambda w: np.uint64(w % (1 << 64))
    total = sum((d.astype(np.uint64) * wrapped(w) for d, w in zip(digits, weights)), np.zeros(parts[0].shape, np.uint64))
    return np.where(negative, total - wrapped(weight), total).astype(np.int64)


class Multiplier:
    """Products of fixed rows with any others, exact up to bound."""

    def __init__(self, rows: np.ndarray, bound: int):
        self.moduli = primes(bound)
        self.rows = [residues(rows, p) for p in self.moduli]

    def __call__(self, others: np.ndarray) -> np.ndarray:
        parts = []
        for p, own in zip(self.moduli, self.rows):
            r = residues(others, p)
            total = np.zeros((len(own), len(others)), np.int64)
            for a in range(0, own.shape[1], DEPTH):
                total += (own[:, a : a + DEPTH] @ r[:, a : a + DEPTH].T).astype(np.int64)
            parts.append(total % p)
        return reconstructed(parts, self.moduli)


class Best:
    """The best k (score, id) of each group."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((groups, k), NONE), np.full((groups, k), LAST)

    def floor(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(groups):
            return
        touched = np.unique(groups)
        groups = np.concatenate([np.repeat(touched, self.k), groups])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, ~scores, groups))
        groups, scores, ids = groups[order], scores[order], ids[order]
        place = np.arange(len(groups)) - np.searchsorted(groups, groups)
        kept = place < self.k
        self.scores[groups[kept], place[kept]], self.ids[groups[kept], place[kept]] = scores[kept], ids[kept]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups, ids and scores."""
        groups, places = np.nonzero(self.scores > NONE)
        return groups, self.ids[groups, places], self.scores[groups, places]


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length: row numbers and vectors, CHUNK rows at a time."""
    flat, offsets = np.asarray(vectors.values), np.asarray(vectors.offsets)
    sizes = np.diff(offsets)
    for d in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == d)
        for a in range(0, len(own), CHUNK):
            rows = own[a : a + CHUNK]
            yield rows, flat[offsets[rows][:, None] + np.arange(d)]


def _mined(vectors: DataFrame, anchors: pa.Table, windows: np.ndarray | None, bound: int, k: int) -> DataFrame:
    """anchor, slot, id, score: each task's k best rows of each anchor and slot. Without windows: one slot, the anchor's own label.
    windows (anchor, slot, 2): rows of other labels, least and greatest score of the slot."""
    slots = 1 if windows is None else windows.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast((anchors, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, windows = shared.value
        anchor_ids, anchor_labels = np.asarray(anchors["vec_id"]), np.asarray(anchors["label"])
        by_length = {}
        for rows, own in matrices(anchors["vector"].combine_chunks()):
            by_length.setdefault(own.shape[1], []).append((rows, Multiplier(own, bound)))
        best = Best(len(anchors) * slots, k)
        for batch in batches:
            ids, labels = np.asarray(column(batch, "vec_id")), np.asarray(column(batch, "label"))
            for rows, own in matrices(column(batch, "vector")):
                for at, times in by_length.get(own.shape[1], ()):
                    scores = times(own)
                    alike = anchor_labels[at][:, None] == labels[rows]
                    for slot in range(slots):
                        group = at * slots + slot
                        fit = scores >= best.floor()[group][:, None]
                        if windows is None:
                            fit &= alike & (anchor_ids[at][:, None] != ids[rows])
                        else:
                            fit &= ~alike & (scores >= windows[at, slot, 0][:, None]) & (scores <= windows[at, slot, 1][:, None])
                        a, b = np.nonzero(fit)
                        best.add(group[a], scores[a, b], ids[rows[b]])
        group, ids, scores = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor_ids[group // slots], group % slots, ids, scores)], names=["anchor_id", "slot", "vec_id", "score"])

    return vectors.select("vec_id", "label", "vector").mapInArrow(run, "anchor_id long, slot long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the best negatives of each anchor and positive
    among the rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    vectors: vec_id, label, vector (array of long)."""
    spark = vectors.sparkSession
    ship_package(spark)
    one = vectors.where("vector is not null and vec_id is not null and label is not null").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct("vector", F.col("label").cast("long").alias("label"))).alias("v"))
    vectors = materialise(one.select("vec_id", "v.label", "v.vector").withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))))
    largest = F.greatest(F.array_max("vector"), -F.array_min("vector"))
    size, length, n_anchors = vectors.agg(F.max(largest), F.max(F.size("vector")), F.count_if("is_anchor")).first()
    bound = (size or 0) ** 2 * (length or 0)
    if bound >= 1 << 62:
        raise ValueError("the vectors' scores could pass 2^62")
    blocks = max(1, -(-n_anchors * 5 // (block * 4)))
    dealt = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(blocks))
    anchors = materialise(vectors.where("is_anchor").select("vec_id", "label", "vector", dealt.alias("block")))
    out = []
    for b in range(blocks):
        own = anchors.where(F.col("block") == b).select("vec_id", "label", "vector").orderBy("vec_id").toArrow()
        for start in range(0, max(1, own.num_rows), block):  # a block that the hash made too large comes in parts
            out.append(_of_block(vectors, own.slice(start, block), bound, positives, negatives, low, high))
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found


def _of_block(vectors: DataFrame, anchors: pa.Table, bound: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    near = materialise(_ranked(_mined(vectors, anchors, None, bound, positives), positives).select("anchor_id", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    told = near.toArrow()  # at most block * positives rows of four numbers
    windows = np.empty((anchors.num_rows, positives, 2), np.int64)
    windows[:, :, 0], windows[:, :, 1] = LAST, NONE
    ids = np.asarray(anchors["vec_id"])
    at = np.searchsorted(ids, np.asarray(told["anchor_id"]))
    score = told["positive_score"].to_pylist()
    slot = np.asarray(told["slot"])
    windows[at, slot, 0] = [-(-low * s // 100) for s in score]
    windows[at, slot, 1] = [high * s // 100 for s in score]
    best = _ranked(_mined(vectors, anchors, windows, bound, negatives), negatives)
    return best.join(near, ["anchor_id", "slot"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
