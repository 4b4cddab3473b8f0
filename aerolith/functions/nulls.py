"""Missing values: NaN becomes null at the scan, and comparisons with null are decided explicitly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every NaN of a float or double column as null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def holds(condition: Column) -> Column:
    """False where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def exceeds(x: Column, limit: float) -> Column:
    return holds(x > limit)


def total(flags: dict[str, int]) -> Column:
    """Bitmask of named boolean columns."""
    out = F.lit(0)
    for name, bit in flags.items():
        out = out + F.col(name).cast("int") * bit
    return out
