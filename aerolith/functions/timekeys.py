"""Keys of zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: str = "ts") -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def epoch_seconds(ts: str = "ts") -> Column:
    return epoch_micros(ts) / F.lit(1_000_000)


def bucket(ts: str, seconds: int) -> Column:
    """Epoch second at which the bucket of a timestamp begins. Buckets start at the epoch, so they must divide a day."""
    if 86_400 % seconds:
        raise ValueError(f"{seconds} s doesn't divide a day")
    return F.floor(epoch_micros(ts) / (seconds * 1_000_000)).cast("long") * seconds
