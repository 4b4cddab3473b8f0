"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(rows: DataFrame, label: Column, key: Column, bound: int) -> DataFrame:
    """About bound rows of each label at most (all, if there are fewer), chosen by a hash of the key. label: not null."""
    rows = rows.withColumn("label", label).where("label is not null")
    shares = {r["label"]: min(1.0, bound / r["n"]) for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("label")]
    return rows.where(F.pmod(F.xxhash64(key.cast("string"), F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))
