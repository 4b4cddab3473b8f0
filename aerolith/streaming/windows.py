"""Window quality on a stream: the same aggregation with a watermark, so that late rows count as long as it allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators.windows import REASONS


def aggregate(stream: DataFrame, channels: Sequence[str], seconds: int = 60, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Counts of masks and means of valid rows per window. ts: timestamp; the stream carries the row masks."""
    valid = [F.avg(F.when(F.col("valid"), F.col(c))).alias(f"{c}_mean") for c in channels]
    counts = [F.count_if(F.col(r)).alias(f"n_{r}") for r in REASONS]
    grouped = stream.withWatermark(ts, late).groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
    return grouped.agg(F.count("*").alias("n_total"), *counts, *valid).select(F.col("w.start").alias("window_start"), "n_total", *[f"n_{r}" for r in REASONS], *[f"{c}_mean" for c in channels])
