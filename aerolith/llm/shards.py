"""Documents in shards, questions in buckets: how the corpus-wide operators look things up.

Shards are groups of documents of a bounded text size, dealt by a hash of id and text. A shard asks
each bucket about distinct keys only, so a very frequent key reaches its bucket once for each shard,
and gets back one answer for each key, in the order of the question. The documents' shuffle is the
same subplan wherever it is used, so Spark runs it once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import ship_package, whole_text

#: Bytes of text in a shard, about.
SHARD_BYTES = 4 << 20


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0


def sharded(docs: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """docs with whole texts and shard, dealt by key and text."""
    ship_package(docs.sparkSession)
    docs = docs.withColumn("text", whole_text())
    return docs.withColumn("shard", F.pmod(F.xxhash64(key, "text"), F.lit(n_shards)).cast("int"))


def segments(offsets: np.ndarray, overlap: int, limit: int) -> Iterator[list[tuple[int, int]]]:
    """Byte ranges of at most limit bytes, gathered into chunks of that size; a longer row gives several, which overlap."""
    chunk, size = [], 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        while a < b:
            end = min(b, a + limit)
            if size and size + end - a > limit:
                yield chunk
                chunk, size = [], 0
            chunk.append((a, end))
            size += end - a
            if end == b:
                break
            a = end - overlap
    if chunk:
        yield chunk


def rows(schema: str, made: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*made)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket's slice of sorted bucket numbers."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)]):
        if b > a:
            yield int(buckets[a]), slice(a, b)


def answered(table: pa.Table, kind: int, field: str, dtype: type) -> np.ndarray:
    """One kind's answers from all buckets, on end in bucket order."""
    own = table.filter(pc.equal(table["kind"], kind)).sort_by("bucket")
    return np.frombuffer(b"".join(own[field].to_pylist()), dtype)


def ask(documents: DataFrame, question: Callable, schema: str, answers: DataFrame | None = None) -> DataFrame:
    """question(documents[, answers]) of each shard, as rows of schema."""
    if answers is None:
        return documents.groupBy("shard").applyInArrow(question, schema)
    return documents.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(question, schema)


def answer(questions: DataFrame, reply: Callable, schema: str) -> DataFrame:
    """reply(questions) of each bucket, as rows of schema."""
    return questions.groupBy("bucket").applyInArrow(reply, schema)
