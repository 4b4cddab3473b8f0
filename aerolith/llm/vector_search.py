"""Operator 3: exact top-k inner products by branch and bound in ball trees.

Vectors are quantised to whole numbers and dealt to shards by a hash of their ids; each shard builds
a ball tree. A node holds vectors within radius r of centre c, so no vector in it can score more
than q.c + |q| r. Blocks of queries visit the nodes in the order of that bound and pass by those
whose bound is below a query's current k-th score. That score is shared twice: between the shards,
which start from the k-th score that each query reached in one small shard of its own, and along
the nodes of a shard.

Queries meet candidates in blocks (a block of queries and a shard are one task's work), so neither
side is ever broadcast or held whole. Vectors that are null, empty or hold null or non-finite
components take no part; vectors of another length than the query's are not its candidates. Of rows
with equal ids, the least vector stands for all. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import materialise, ship_package

SHARD_ROWS, BLOCK_ROWS, LEAF = 16_384, 2_048, 128


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    whole = F.size(vector) > 0
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class BallTree:
    """Nodes (centre, radius, lo, hi) over an order of the rows."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.centres, self.radii, self.spans, self.children = [], [], [], []
        x = vectors.astype(np.float64)
        todo = [(0, len(x), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            own = x[self.order[lo:hi]]
            centre = own.mean(axis=0)
            far = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.spans)
            self.centres.append(centre)
            self.radii.append(far.max() * (1 + 1e-9))
            self.spans.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo > LEAF:
                a = own[far.argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                side = own @ (b - a)
                order = np.argsort(side, kind="stable")
                self.order[lo:hi] = self.order[lo:hi][order]
                mid = (lo + hi) // 2
                todo += [(lo, mid, node), (mid, hi, node)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer products; by floating point where that is exact."""
    if np.abs(q).max(initial=0).astype(float) * np.abs(v).max(initial=0).astype(float) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k scores and ids of each query among the vectors (missing: the least integer); floor: scores that the k-th reaches at least."""
    none = np.iinfo(np.int64).min
    scores, found = np.full((len(queries), k), none), np.full((len(queries), k), np.iinfo(np.int64).max)
    if not len(vectors):
        return scores, found
    tree = BallTree(vectors)
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    bounds = queries.astype(np.float64) @ tree.centres.T + lengths[:, None] * tree.radii
    bounds += 1e-9 * np.abs(bounds) + 1e-6
    kth = floor.copy()
    todo = [0]
    while todo:
        node = todo.pop()
        active = np.flatnonzero(bounds[:, node] >= kth)
        if not len(active):
            continue
        if tree.children[node]:
            todo += sorted(tree.children[node], key=lambda n: bounds[active, n].sum())
            continue
        lo, hi = tree.spans[node]
        rows = tree.order[lo:hi]
        got = exact_products(queries[active], vectors[rows])
        got[ids[rows] == query_ids[active][:, None]] = none
        all_scores = np.hstack([scores[active], got])
        all_ids = np.hstack([found[active], np.broadcast_to(ids[rows], got.shape)])
        all_ids[all_scores == none] = np.iinfo(np.int64).max
        order = np.lexsort((all_ids, -np.maximum(all_scores, none + 1)))[:, :k]
        scores[active], found[active] = np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_ids, order, 1)
        kth[active] = np.maximum(kth[active], scores[active][:, -1])
    return scores, found


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each query row. vectors: vec_id, vector (array of long)."""
    ship_package(vectors.sparkSession)
    vectors = vectors.where("vector is not null and vec_id is not null").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("vector").alias("vector"))
    vectors = materialise(vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))))
    n, n_queries = vectors.agg(F.count("*"), F.count_if("is_query")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_rows))
    dealt = lambda seed, parts: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    queries = vectors.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), dealt(1, blocks).alias("block"))
    schema = "query_id long, vec_id long, score long"

    def matrix(table: pa.Table, column: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length: row numbers and vectors."""
        lists = table[column].combine_chunks()
        sizes = np.diff(np.asarray(lists.offsets))
        flat, starts = np.asarray(lists.values), np.asarray(lists.offsets)[:-1]
        out = {}
        for d in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == d)
            out[d] = own, flat[starts[own][:, None] + np.arange(d)]
        return out

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, query_ids, floor = (np.asarray(c.combine_chunks()) for c in (right["vec_id"], left["query_id"], left["floor"]))
            candidates = matrix(right, "vector")
            for d, (rows, q) in matrix(left, "query").items():
                if d in candidates:
                    own, v = candidates[d]
                    scores, found = search(q, query_ids[rows], floor[rows], v, ids[own], k)
                    hit = scores > np.iinfo(np.int64).min
                    out.append((np.repeat(query_ids[rows], hit.sum(axis=1)), found[hit], scores[hit]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    def joined(asked: DataFrame, of: DataFrame) -> DataFrame:
        return asked.groupBy("block", "shard").cogroup(of.groupBy("block", "shard")).applyInArrow(meet, schema)

    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    lowest = F.lit(-(1 << 63))
    # One small shard for each block gives the scores to start from.
    home = vectors.where(dealt(2, max(1, n // 1024)) == 0).select("vec_id", "vector", every(blocks).alias("block"), F.lit(0).alias("shard"))
    first = joined(queries.select("block", F.lit(0).alias("shard"), "query_id", "query", lowest.alias("floor")), home)
    floors = first.groupBy(F.col("query_id").alias("of")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(lowest).alias("floor"))
    asked = queries.join(floors, F.col("query_id") == F.col("of"), "left").select("block", every(shards).alias("shard"), "query_id", "query", F.coalesce("floor", lowest).alias("floor"))
    candidates = vectors.select("vec_id", "vector", every(blocks).alias("block"), dealt(3, shards).alias("shard"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = joined(asked, candidates).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
