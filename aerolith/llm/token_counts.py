"""Operator 8: token counts through a digest cache.

The cache is a Parquet table of (version, digest, n_tokens): version is the digest of the tokenizer
file, digest that of the normalised content (null as empty; counts depend on every other byte).
Documents are joined to it by both; of the texts that miss, one copy each is encoded, and its count
is appended to the cache before the counts are joined to all documents.

Repeated rows each give a row; an empty text has no tokens; an empty table leaves the cache as it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.bpe import encode_like_library
from aerolith.llm.common import per_chunk, ship_package, whole_text

CACHE_SCHEMA = "version string, digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:16]


def read_cache(docs: DataFrame, cache_path: str, version: str) -> DataFrame | None:
    """Stored counts of one tokenizer version, one for each digest (a retried or doubled append counts once); None before the first append."""
    try:
        stored = docs.sparkSession.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("stored_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text; appends the counts of new texts to the cache."""
    ship_package(docs.sparkSession)
    version = tokenizer_version(tokenizer_path)

    def work(texts: pa.Array, digest: pa.Array) -> pa.RecordBatch:
        _, ends = encode_like_library(tokenizer_path, texts)
        return pa.record_batch([digest, pa.array(np.diff(ends), pa.int64())], names=["digest", "n_tokens"])

    text = whole_text()
    digested = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    stored = read_cache(docs, cache_path, version)
    missed = digested.select("digest", "text")
    if stored is not None:
        missed = missed.join(stored, "digest", "left_anti")
    distinct = missed.groupBy("digest").agg(F.first("text").alias("text"))
    counted = distinct.mapInArrow(per_chunk(work, "digest"), "digest binary, n_tokens long")
    counted.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_path)
    stored = read_cache(docs, cache_path, version)
    return digested.drop("text").join(stored, "digest", "left").select("doc_id", "n_bytes", F.col("stored_tokens").alias("n_tokens"))
