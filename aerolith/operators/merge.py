"""Placing instruments on one timeline: buckets side by side, gap filling, stacking and de-duplication."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.timekeys import bucket
from aerolith.operators.blocks import at_home, haloed, within

#: Seconds of a block of a date.
BLOCK = 14_400


def timeline(dates: DataFrame, step: int, date: str = "flight_date") -> DataFrame:
    """(date, slot_s): every step of each date, in seconds of the day."""
    return dates.select(date).distinct().select(date, F.explode(F.sequence(F.lit(0), F.lit(86_400 - step), F.lit(step))).alias("slot_s"))


def beside(long: DataFrame, step: int, variables: Sequence[str], date: str = "flight_date", ts: str = "ts") -> DataFrame:
    """One row per date and step that has a value, one column per variable: the mean of its values in the step."""
    slots = long.groupBy(date, bucket(ts, step).alias("slot")).pivot("variable", list(variables)).agg(F.avg("value"))
    return slots.dropna("all", subset=list(variables))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def concat_dates(frames: Sequence[DataFrame], order: Sequence[str], date: str = "flight_date") -> DataFrame:
    """The frames of single dates as one, each date in one partition and in order there."""
    return stack(frames).repartition(date).sortWithinPartitions(date, *order)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given (total) order."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def _neighbours(df: DataFrame, value: str, max_gap: float, date: str, order: str, size: float) -> DataFrame:
    """df with the last value up to a row and the first one from it on, with their places, as far as max_gap away at least; in
    blocks of a date with halos of max_gap, so that a date is many tasks."""
    blocks = haloed(df, F.col(order), max_gap, max(size, max_gap))
    along = within(date).orderBy(order)
    past, future = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    return at_home(blocks.withColumns({"_v0": F.last(value, True).over(past), "_t0": F.last(at, True).over(past), "_v1": F.first(value, True).over(future), "_t1": F.first(at, True).over(future)}))


def fill_linear(df: DataFrame, value: str, out: str, max_gap: float, date: str = "flight_date", order: str = "slot_s", size: float = BLOCK) -> DataFrame:
    """Gaps between two values of a date that are at most max_gap apart, filled linearly."""
    df = _neighbours(df, value, max_gap, date, order, size)
    line = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.try_divide(F.col(order) - F.col("_t0"), F.col("_t1") - F.col("_t0"))
    filled = F.coalesce(F.col(value), F.when(F.col("_t1") - F.col("_t0") <= max_gap, line))
    return df.withColumn(out, filled).drop("_v0", "_t0", "_v1", "_t1")


def fill_nearest(df: DataFrame, value: str, out: str, max_gap: float, date: str = "flight_date", order: str = "slot_s", size: float = BLOCK) -> DataFrame:
    """The nearest value of the date within max_gap; the earlier one on ties."""
    df = _neighbours(df, value, max_gap, date, order, size)
    back, ahead = F.col(order) - F.col("_t0"), F.col("_t1") - F.col(order)
    back_ok, ahead_ok = F.coalesce(back <= max_gap, F.lit(False)), F.coalesce(ahead <= max_gap, F.lit(False))
    filled = F.when(back_ok & (~ahead_ok | (back <= ahead)), F.col("_v0")).when(ahead_ok, F.col("_v1"))
    return df.withColumn(out, filled).drop("_v0", "_t0", "_v1", "_t1")


def asof(left: DataFrame, right: DataFrame, on: str, columns: Mapping[str, str], tolerance: float, direction: str = "backward", by: Sequence[str] = (), matched: str = "matched_at", size: float = BLOCK) -> DataFrame:
    """left with columns (new name: column of right) of the right row with the closest place `on` at most tolerance away: the last
    one up to it (backward), the first one from it on (forward) or the nearer of both (nearest; the earlier one on ties), and
    matched, its place. by: columns that must be equal (null equals null).

    Both sides are put on end and sorted once for each direction in blocks of `size` places; only right rows are copied, to the blocks whose rows
    they can reach. So neither side is broadcast, no pairs are made, and a hot key is as many tasks as it has blocks. Of right rows of one
    place the one with the greatest columns counts. Left rows without a place, or without a match, have nulls."""
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction}")
    if clash := {*columns, matched} & set(left.columns):
        raise ValueError(f"left has {', '.join(sorted(clash))} already")
    reach, key = max(float(tolerance), 0.0), [F.col(c) for c in by]
    keys = [c.alias(f"_k{i}") for i, c in enumerate(key)]
    own = left.select(*keys, F.col(on).cast("double").alias("_at"), F.lit(0).alias("_side"), F.struct(*left.columns).alias("_l"))
    found = F.struct(F.col(on).alias(matched), *[F.col(c).alias(n) for n, c in columns.items()])
    guests = right.where(F.col(on).isNotNull()).select(*keys, F.col(on).cast("double").alias("_at"), F.lit(1).alias("_side"), found.alias("_r"))
    width = max(size, reach) or 1.0
    own = own.withColumn("_block", F.floor(F.col("_at") / width))
    guests = haloed(guests, F.col("_at"), reach, width).drop("_home")
    both = own.unionByName(guests, allowMissingColumns=True)
    block = Window.partitionBy(*[f"_k{i}" for i in range(len(key))], "_block")
    last = F.last("_r", ignorenulls=True)
    back = last.over(block.orderBy("_at", F.desc("_side"), "_r").rowsBetween(Window.unboundedPreceding, 0))
    ahead = last.over(block.orderBy(F.desc("_at"), F.desc("_side"), "_r").rowsBetween(Window.unboundedPreceding, 0))
    met = both.withColumns({k: v for k, v in (("_b", back), ("_a", ahead)) if direction == "nearest" or k == {"backward": "_b", "forward": "_a"}[direction]}).where("_side = 0")
    gap = lambda c: F.abs(F.col(f"{c}.{matched}").cast("double") - F.col("_at"))
    fits = lambda c: F.when(gap(c) <= reach, F.col(c))
    if direction == "nearest":
        best = F.when(fits("_b").isNotNull() & (fits("_a").isNull() | (gap("_b") <= gap("_a"))), fits("_b")).otherwise(fits("_a"))
    else:
        best = fits("_b" if direction == "backward" else "_a")
    return met.withColumn("_best", best).select("_l.*", "_best.*")


def drop_matching(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Without the columns whose name holds one of the patterns."""
    return df.drop(*[c for c in df.columns if any(re.search(p, c) for p in patterns)])


def merge_metadata(frames: Sequence[DataFrame]) -> DataFrame:
    """(title, field, value) of all frames, each once."""
    return stack(frames).select("title", "field", "value").distinct()
