"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the vectorised steps hold at once; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; read by Spark alone, so any store that Spark knows will do. A table whose rows lie in
    fewer partitions than the cluster has cores is dealt out to all of them. A file's row group is read by one task, so
    where there are few partitions those that hold rows are counted (from the files' footers)."""
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    filled = df.rdd.getNumPartitions()
    if cores <= filled < 4 * cores:
        filled = df.select(F.spark_partition_id().alias("part")).distinct().count()
    return df.repartition(cores) if filled < cores else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their tasks can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_aerolith_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}_code", "zip", package.parent, package.name)
    sc.addPyFile(archive)
    sc._aerolith_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder. Where none is configured, a temporary one will do on one machine;
    on a cluster that is an error, as executors and driver don't see each other's temporary folders."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: it must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes of text (or of one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, stop
        start = stop


def utf8_data(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows on end and the rows' offsets in them (null: empty)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


_remembered: dict[str, dict[str, object]] = {}


def remembered(kind: str, name: str, make: Callable, full: Callable = lambda held: False) -> object:
    """What this worker remembers for a model of a kind: two models at most, made anew when full, and dropped when
    another kind's turn comes, so that the stages of a pipeline don't add up in a worker that they share."""
    if kind not in _remembered:
        _remembered.clear()
    held = _remembered.setdefault(kind, {})
    if name not in held or full(held[name]):
        if len(held) > 1:
            held.clear()
        held[name] = make()
    return held[name]


def forget() -> None:
    """Drop what this worker remembers for models, before work that needs the memory."""
    _remembered.clear()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def per_chunk(work: Callable, *fixed: str) -> Callable:
    """A mapInArrow function that calls work(texts, *columns) on each chunk of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for a, b in text_chunks(texts):
                yield work(texts.slice(a, b - a), *(column(batch, c).slice(a, b - a) for c in fixed))

    return run


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... for lengths[i] each, on end."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total, dtype=np.int64)
