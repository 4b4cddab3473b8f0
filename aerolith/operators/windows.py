"""Tumbling windows: counts of all rows and statistics of valid ones in one aggregation, and their flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.timekeys import bucket, epoch_micros
from aerolith.operators.blocks import ROWS, around
from aerolith.operators.quantiles import quantiles

TOO_FEW, UNSTABLE, MISSING = 1, 2, 4
REASONS = ("cloudy", "inlet_bad", "low_signal", "low_ssa", "valid")


def aggregate(df: DataFrame, channels: Sequence[str], seconds: int = 60, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """Per window: n_total, the count of each mask, and mean, deviation (n - 1) and count of each channel's valid rows."""
    valid = F.col("valid")
    stats = [f(F.when(valid, F.col(c))).alias(f"{c}_{name}") for c in channels for name, f in (("mean", F.avg), ("std", F.stddev_samp))]
    counts = [F.count_if(F.col(r)).alias(f"n_{r}") for r in REASONS]
    return df.groupBy(*by, bucket(ts, seconds).alias("window_start")).agg(F.count("*").alias("n_total"), *counts, *stats)


def raw_statistics(df: DataFrame, columns: Sequence[str], seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Mean, deviation and count of whole columns per window, whatever their quality."""
    stats = [f(c).alias(f"{c}_{name}") for c in columns for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("n", F.count))]
    return df.groupBy(bucket(ts, seconds).alias("window_start")).agg(*stats)


def bounds(windows: DataFrame, seconds: int = 60) -> DataFrame:
    """time_start, time_end and centre, in epoch seconds."""
    start = F.col("window_start")
    return windows.withColumns({"time_start": start, "time_end": start + seconds, "time_centre": start + F.lit(seconds / 2)})


def spectrum_means(df: DataFrame, spectrum: str, n_bins: int, seconds: int = 60, min_per_bin: int = 10, ts: str = "ts") -> DataFrame:
    """Mean spectrum of the valid rows of each window; a bin with fewer than min_per_bin values is null."""
    at = lambda i: F.when(F.col("valid"), F.get(F.col(spectrum), F.lit(i)))
    means = F.array(*[F.when(F.count(at(i)) >= min_per_bin, F.avg(at(i))) for i in range(n_bins)])
    return df.groupBy(bucket(ts, seconds).alias("window_start")).agg(means.alias(spectrum))


def quality_flag(stability: str, required: Sequence[str], min_valid: int = 20, limit: float = 0.3, mode: str = "relative") -> Column:
    """Bits: too few valid rows, unstable (or missing) Angstrom exponent, missing optics."""
    mean, std = F.col(f"{stability}_mean"), F.col(f"{stability}_std")
    if mode not in ("relative", "absolute"):
        raise ValueError(f"unknown mode {mode}")
    unstable = F.coalesce(std > (limit * F.abs(mean) if mode == "relative" else F.lit(limit)), F.lit(True))
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(f"{c}_mean").isNull()
    bit = lambda condition, b: F.when(condition, b).otherwise(0)
    return bit(F.col("n_valid") < min_valid, TOO_FEW) + bit(unstable, UNSTABLE) + bit(missing, MISSING)


def first_passing(windows: DataFrame, n: int, flag: str = "window_qc_flag", start: str = "window_start") -> DataFrame:
    """The first n windows that pass, and all that don't. Each task keeps its own first n, so that few rows meet."""
    return windows.where(F.col(flag) == 0).orderBy(start).limit(n).unionByName(windows.where(F.col(flag) != 0))


def funnel(results: DataFrame) -> DataFrame:
    """One row: windows, those that pass, those with a retrieval, those with both retrievals."""
    passed = F.col("window_qc_flag") == 0
    cri, kappa = F.coalesce(F.col("attempt_flag_cri") == 2, F.lit(False)), F.coalesce(F.col("attempt_flag_kappa") == 2, F.lit(False))
    return results.agg(F.count("*").alias("n_windows"), F.count_if(passed).alias("n_pass"), F.count_if(passed & cri).alias("n_cri"), F.count_if(passed & cri & kappa).alias("n_kappa"))


def native_step(df: DataFrame, date: str = "flight_date", ts: str = "ts", size: int = ROWS) -> DataFrame:
    """Median seconds between rows of each date; 1 where there are fewer than two. Rows meet the one before in blocks."""
    rows = df.select(date, ts, epoch_micros(ts).alias("_at"))
    steps = around(rows, "_before", F.max("_at"), 1, -1, date, (ts,), size=size).select(date, ((F.col("_at") - F.col("_before")) / 1e6).alias("step"))
    found = quantiles(steps, "step", [0.5], [date]).select(F.col(date).alias("_date"), F.col("q")[0].alias("_step"))
    return df.select(date).distinct().join(found, F.col(date).eqNullSafe(F.col("_date")), "left").select(date, F.coalesce("_step", F.lit(1.0)).alias("step_s"))


def vector_wind(df: DataFrame, speed: str, direction: str, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Mean wind vector per window: speed and the direction it comes from."""
    angle = F.radians(F.col(direction))
    parts = df.groupBy(bucket(ts, seconds).alias("window_start")).agg(F.avg(-F.col(speed) * F.sin(angle)).alias("u"), F.avg(-F.col(speed) * F.cos(angle)).alias("v"))
    return parts.select("window_start", F.sqrt(F.col("u") ** 2 + F.col("v") ** 2).alias("wind_speed"), F.pmod(F.degrees(F.atan2(-F.col("u"), -F.col("v"))), F.lit(360.0)).alias("wind_direction"))
