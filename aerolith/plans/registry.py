"""Registered queries: every operator on frames derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places (sums differ in the last bits by partitioning), whole numbers as long, dates as text."""
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(c.cast("double"), 6) + 0.0
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = c.cast("long")
        elif isinstance(f.dataType, (T.DateType, T.BooleanType)):
            out[f.name] = c.cast("string")
    return df.withColumns(out) if out else df


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(f(spark, sf_dir))

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return f


from aerolith.plans import align_queries, catalog_queries, flight_queries, product_queries, qc_queries, source_queries, spectrum_queries  # noqa: E402, F401
