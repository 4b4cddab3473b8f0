"""Per-window retrieval as joins: inputs, lookup-table search, failures, assembly and flags."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.packages import ship_package
from aerolith.functions.storage import written
from aerolith.operators.lut import Table
from aerolith.operators.spectra import pattern

OK, SKIPPED, FAILED = 0, 1, 2
PER_MM = 1e-6
#: Bytes of kernels that are broadcast at once.
BLOCK_BYTES = 64 << 20


def inputs(windows: DataFrame, spectrum: str, scattering: Sequence[str], absorption: Sequence[str], diameters_um: Sequence[float], flag: str = "window_qc_flag") -> DataFrame:
    """Windows that pass, with radii, spectrum and coefficients in SI units."""
    si = lambda columns: F.array(*[F.col(c) * PER_MM for c in columns])
    radii = F.transform(F.array(*[F.lit(float(d)) for d in diameters_um]), lambda d: d / 2)
    return windows.where(F.col(flag) == 0).select("window_start", radii.alias("radii_um"), F.col(spectrum).alias("spectrum"), si(scattering).alias("sca_per_m"), si(absorption).alias("abs_per_m"))


def grid_search(windows: DataFrame, measured: Sequence[str], spectrum: str, kernels: DataFrame, tolerance: float, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """window_start, candidate, residual, attempt_flag_cri: the best candidate of each window. kernels: candidate (whole number),
    channel (position in measured), kernel (array over bins).

    A candidate's optics are the dot product of kernel and spectrum, where missing bins give nothing; the residual is the
    mean squared relative deviation over the channels that count: those that the candidate has and whose measurement is
    neither missing nor zero. Ties go to the smaller candidate. Without a channel that counts, candidate and residual are
    null and the flag is 1. Rows of one window_start give one row, the better one. No kernels: no candidate.

    Kernels come in blocks of at most block_bytes, counted beforehand, each of which is broadcast; windows are read once
    for each block and never meet all candidates: leaves of similar kernels are passed by where a norm bound shows that they
    can't be better than what was found (`lut`).
    """
    spark, n_channels = windows.sparkSession, len(measured)
    ship_package(spark)
    known = kernels.where(F.col("channel").between(0, n_channels - 1) & F.col("candidate").isNotNull() & F.col("kernel").isNotNull())
    filled = F.transform("kernel", lambda x: F.coalesce(F.when(~F.isnan(x.cast("double")), x.cast("double")), F.lit(0.0)))
    known = known.select(F.col("candidate").cast("long").alias("candidate"), F.col("channel").cast("int").alias("channel"), filled.alias("kernel"))
    n_candidates, n_bins = known.agg(F.count_distinct("candidate"), F.max(F.size("kernel"))).first()
    n_bins = max(1, n_bins or 1)
    each = max(1, block_bytes // (8 * n_channels * n_bins))  # candidates of a block
    blocks = max(1, -(-n_candidates // each))
    # Twice as many blocks as the bytes need, so that none that the hash makes larger passes the bound.
    dealt = written(known.withColumn("block", F.pmod(F.xxhash64("candidate"), F.lit(blocks if blocks == 1 else 2 * blocks))))
    keyed = written(windows.select("window_start", spectrum, *measured)) if blocks > 1 else windows.select("window_start", spectrum, *measured)

    def searched(block: pa.Table) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = _lookup(shared.value, n_channels, n_bins)
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                spectra = _matrix(rows[spectrum], n_bins)
                values = np.array([np.asarray(rows[c].cast(pa.float64()).fill_null(np.nan)) for c in measured]).T.reshape(len(spectra), n_channels)
                values = np.where((values == 0) | ~np.isfinite(values), np.nan, values)
                residual, candidate = lookup.best(spectra, values) if lookup else (np.full(len(spectra), np.inf), np.zeros(len(spectra), np.int64))
                none = ~np.isfinite(residual)
                yield pa.RecordBatch.from_arrays([rows["window_start"].combine_chunks(), pa.array(residual, mask=none), pa.array(candidate, mask=none)], names=["window_start", "residual", "candidate"])

        kind = windows.schema["window_start"].dataType.simpleString()
        return keyed.mapInArrow(run, f"window_start {kind}, residual double, candidate long")

    parts = [searched(dealt.where(F.col("block") == b).drop("block").toArrow()) for b in range(blocks if blocks == 1 else 2 * blocks)]
    found = reduce(DataFrame.unionByName, parts)
    best = F.min(F.when(F.col("residual").isNotNull(), F.struct("residual", "candidate")))
    return found.groupBy("window_start").agg(best.alias("b")).select("window_start", "b.candidate", "b.residual", F.when(F.col("b.residual") <= tolerance, 2).otherwise(1).alias("attempt_flag_cri"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of numbers, cut or filled with 0 to width; null and non-finite numbers are 0."""
    own = lists.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(own), 0)).astype(np.int64)
    flat = np.nan_to_num(np.asarray(pc.list_flatten(own).cast(pa.float64()).fill_null(0.0)), nan=0.0, posinf=0.0, neginf=0.0)
    out, row = np.zeros((len(own), width)), np.repeat(np.arange(len(own)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row[place < width], place[place < width]] = flat[place < width]
    return out


def _lookup(block: pa.Table, n_channels: int, n_bins: int) -> Table | None:
    if not block.num_rows:
        return None
    candidates, at = np.unique(np.asarray(block["candidate"]), return_inverse=True)
    channel = np.asarray(block["channel"])
    kernels, has = np.zeros((len(candidates), n_channels, n_bins)), np.zeros((len(candidates), n_channels), bool)
    kernels[at, channel], has[at, channel] = _matrix(block["kernel"], n_bins), True
    return Table(candidates, kernels, has)


def failures(windows: DataFrame, spectrum: str) -> DataFrame:
    """retrieval_error of windows with under two valid bins; their attempt flag is 0, others' null."""
    few = F.size(pattern(F.col(spectrum))) < 2
    return windows.withColumns({"attempt_flag_cri": F.when(few, 0), "retrieval_error": F.when(few, F.lit("fewer than 2 valid bins"))})


def assemble(windows: DataFrame, results: DataFrame, key: str | Sequence[str] = "window_start") -> DataFrame:
    """Windows with their results. Where both are bucketed by the key, nothing is shuffled."""
    return windows.join(results, [key] if isinstance(key, str) else list(key), "left")


def quality_flag(window_flag: Column, attempt: Column) -> Column:
    """0: retrieved; 1: never attempted, as the window fails; 2: attempted without success."""
    passed, success = F.coalesce(window_flag == 0, F.lit(False)), F.coalesce(attempt == 2, F.lit(False))
    return F.when(passed & success, OK).when(passed, FAILED).otherwise(SKIPPED)
