"""Operator 1: Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the longest known one and
the byte behind it, and is then known itself. The distinct phrases are hashed; the smallest hashes
are the fingerprint. Two fingerprints' likeness estimates the Jaccard likeness of the phrase sets.

A text's dictionary holds all its phrases; hashes are taken a few megabytes of phrases at a time.
Null and empty texts have the empty fingerprint; two of those are alike (1), one and another are
not (0). Rows with equal ids follow each other by text, descending, or, where an id has so many rows
that they fill several buckets, by a hash of the text and then by text; null ids come last, behind every number.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, ship_package, whole_text
from aerolith.llm.hashing import range_hashes
from aerolith.llm.shards import text_bytes

#: Hashes of a fingerprint; bytes of phrases hashed at once; bytes of text in a bucket, about.
KEPT, STEP, BUCKET_BYTES = 64, 4 << 20, 8 << 20
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def parse(data: bytes, book: dict[int, int], node: int, at: int, ends: array) -> int:
    """Parse data, which begins at position at of its text, onwards from node; notes where phrases end. The book's
    entries are in the order of the phrases."""
    get, put = book.get, ends.append
    size = len(book) + 1 << 8
    for i, c in enumerate(data, at + 1):
        child = get(node | c)
        if child is None:
            book[node | c] = size
            size += 256
            node = 0
            put(i)
        else:
            node = child
    return node


def signature(data: bytes, ends: array) -> np.ndarray:
    """The smallest distinct hashes of the phrases that end at ends (and of what is left behind the last)."""
    out = np.zeros(0, np.uint32)
    if not data:
        return out
    b = np.array(ends, np.int64)
    if not len(b) or b[-1] < len(data):
        b = np.append(b, len(data))
    raw, at, start = np.frombuffer(data, np.uint8), 0, 0
    while at < len(b):
        stop = max(at + 1, int(np.searchsorted(b, start + STEP, side="right")))
        own = b[at:stop] - start
        hashes = (range_hashes(raw[start : b[stop - 1]], np.append(0, own[:-1]), own) >> np.uint64(32)).astype(np.uint32)
        out = np.unique(np.append(out, hashes))[:KEPT]
        at, start = stop, int(b[stop - 1])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common hashes among the smallest of both."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:KEPT]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def shown(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


class Parsed:
    """A text's fingerprint, and its parse as far as the edit leaves the text alone."""

    def __init__(self, text: str):
        kept = len(text) - len(text) // 2
        self.text, self.kept_bytes = text, text[:kept].encode()
        self.book: dict[int, int] = {}
        self.ends = array("q")
        self.node = parse(self.kept_bytes, self.book, 0, 0, self.ends)
        n = len(self.ends)
        tail = text[kept:].encode()
        parse(tail, self.book, self.node, len(self.kept_bytes), self.ends)
        self.signature = signature(self.kept_bytes + tail, self.ends)
        # What the later half added is forgotten again, for the edit.
        for _ in range(len(self.ends) - n):
            self.book.popitem()
        del self.ends[n:]

    def edited(self, following: str) -> tuple[bytes, np.ndarray]:
        """The text with its later half replaced by the beginning of another, and that text's fingerprint."""
        tail = following[: len(self.text) // 2].encode()
        parse(tail, self.book, self.node, len(self.kept_bytes), self.ends)
        data = self.kept_bytes + tail
        return data, signature(data, self.ends)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every whole text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text").to_pylist()
            prints = [shown(Parsed(t).signature) for t in texts]
            yield pa.record_batch([column(batch, "doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(prints, pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def place_limits(ids: DataFrame, buckets: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Where buckets begin, as (id, key) in ascending order, and the ids whose rows fill several buckets (null counts as LEAST).
    Two numbers for each bucket are all that the driver sees. ids: a column id of longs, LEAST for null."""
    if buckets < 2:
        return [], []
    found = Counter(ids.select(F.col("id").cast("double").alias("id")).approxQuantile("id", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)))
    limits = {(min(int(b), GREATEST), LEAST) for b in found}
    hot = []
    repeated = [b for b, n in found.items() if n > 1]
    if repeated:
        n = ids.count()
        # Doubles stand for several ids where these are large, so the rows of each are counted.
        for r in ids.where(F.col("id").cast("double").isin(repeated)).groupBy("id").count().orderBy(F.desc("count"), "id").limit(buckets).collect():
            parts = -(-r["count"] * buckets // n)
            if parts > 1:
                hot.append(r["id"])
                # Keys are even over the numbers from zero on; those of null ids over the numbers below.
                limits |= {(r["id"], -(-i * GREATEST // parts)) for i in range(-parts if r["id"] == LEAST else 0, parts)} | {(r["id"], LEAST)}
                limits |= {(r["id"] + 1, LEAST)} if r["id"] < GREATEST else set()
    return sorted(limits), sorted(hot)


def with_following(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, guest, id, key, text) such that, in the order (guest, id, key, text, all but guest descending) of a
    bucket, each own row is followed by the next document: the last of a bucket by a guest, the first of the
    next bucket's. After the last document comes the first. Buckets are ranges of (id, key) of about equal counts. The key of a null
    id is negative; it tells rows of one id apart by their texts' hashes where the id's rows fill several buckets. Only repeated
    rows (id and text) are never told apart. The buckets' limits and greatest rows, a few numbers for each bucket of about BUCKET_BYTES,
    are all that the driver sees."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), F.col("doc_id").isNull().alias("none"), whole_text().alias("text"))
    bounds, hot = place_limits(rows.select("id"), buckets)
    limit_ids, limit_keys = (np.array(x, np.int64) for x in (zip(*bounds) if bounds else ((), ())))
    hashed = F.when(F.col("id").isin(hot), F.xxhash64("text").bitwiseAND(F.lit(GREATEST))).otherwise(F.lit(0)) if hot else F.lit(0)
    rows = rows.select("id", (hashed + F.when(F.col("none"), F.lit(LEAST)).otherwise(F.lit(0))).cast("long").alias("key"), "text")

    @F.pandas_udf("int")
    def bucket_of(id: pd.Series, key: pd.Series) -> pd.Series:
        ids, keys = id.to_numpy(np.int64), key.to_numpy(np.int64)
        first, last = np.searchsorted(limit_ids, ids, side="left"), np.searchsorted(limit_ids, ids, side="right")
        for lo in np.unique(first[first < last]).tolist():
            own = np.flatnonzero((first == lo) & (first < last))
            last[own] = lo + np.searchsorted(limit_keys[lo : last[own[0]]], keys[own], side="right")
        return pd.Series(last.astype(np.int32))

    head = F.max(F.struct("id", "key")).alias("head")
    heads = sorted((r["bucket"], *r["head"]) for r in rows.groupBy(bucket_of("id", "key").alias("bucket")).agg(head).collect())
    if not heads:
        return rows.select(F.lit(0).alias("bucket"), F.lit(False).alias("guest"), "id", "key", "text")
    filled, head_ids, head_keys = (np.array(x, np.int64) for x in zip(*heads))
    next_bucket = np.roll(filled, -1)

    @F.pandas_udf("int")
    def guest_of(bucket: pd.Series, id: pd.Series, key: pd.Series) -> pd.Series:
        """The bucket that needs the row as a guest (-1: none)."""
        at = np.searchsorted(filled, bucket.to_numpy())
        leads = (head_ids[at] == id.to_numpy(np.int64)) & (head_keys[at] == key.to_numpy(np.int64))
        return pd.Series(np.where(leads, next_bucket[at], -1).astype(np.int32))

    placed = rows.withColumn("bucket", bucket_of("id", "key")).withColumn("other", guest_of("bucket", "id", "key"))
    places = F.array_compact(F.array(F.struct("bucket", F.lit(False).alias("guest")), F.when(F.col("other") >= 0, F.struct(F.col("other").alias("bucket"), F.lit(True).alias("guest")))))
    return placed.select(F.explode(places).alias("place"), "id", "key", "text").select("place.bucket", "place.guest", "id", "key", "text")


def compare_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. doc_id must be a whole
    number (it is ordered and cast to long). buckets: by the text's size, if not given."""
    ship_package(docs.sparkSession)
    if buckets is None:
        # Twice the cores at least, as buckets are dealt by a hash, but none under a 16th of BUCKET_BYTES.
        size = text_bytes(docs)
        buckets = max(1, -(-size // BUCKET_BYTES), min(2 * docs.sparkSession.sparkContext.defaultParallelism, 16 * size // BUCKET_BYTES))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, doc, waiting = None, None, None
        for batch in batches:
            out = []
            for at, guest, id, key, text in zip(*(column(batch, c).to_pylist() for c in ("bucket", "guest", "id", "key", "text"))):
                if at != bucket:
                    bucket, waiting = at, None
                if guest and waiting is None:
                    continue
                parsed = Parsed(text)
                if waiting is not None:
                    data, edited = waiting.edited(text)
                    own = waiting.signature
                    out.append((doc, len(waiting.text), hashlib.sha256(data).hexdigest(), shown(own), shown(edited), likeness(own, edited), likeness(own, parsed.signature)))
                doc, waiting = (None, None) if guest else (None if key < 0 else id, parsed)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    ordered = with_following(docs, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket", "guest", F.desc("id"), F.desc("key"), F.desc("text"))
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
