"""Connected components by alternating large and small stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (large: the greater, else the smaller and the node) to the least of all."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = (near.where("b > a") if large else near).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.union(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node reachable) of every node that a link (a, b) names."""
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = state(links)
    while before[0]:
        links = materialise(_star(_star(links, large=True), large=False))
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
