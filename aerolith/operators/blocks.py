"""Rows by position or time in blocks, so that one date is many tasks.

A window over a date's rows puts the date into one task. Here a date is cut into blocks, and each block also gets the rows
of its neighbours that its own rows look at (the halo); a window over (date, block) then gives its own rows what a window
over the date would, and the guests go. Copies are 2 * halo of every `size` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions.timekeys import bucket

#: Rows of a block by position, and seconds of a cell in which positions are counted.
ROWS, CELL = 8192, 3600


def positions(df: DataFrame, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), cell: Column | None = None, out: str = "rn") -> DataFrame:
    """Each row's position within its date (from 1). Rows are numbered within cells of time and counted on from the cells before;
    the counts are one narrow aggregation. cell: what never falls along the order; by default hours of order[0] if that is a timestamp, ROWS of it if a
    number, else the date is one cell."""
    if cell is None:
        kind = df.schema[order[0]].dataType
        cell = bucket(order[0], CELL) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.floor(F.col(order[0]) / ROWS) if isinstance(kind, T.NumericType) else F.lit(0)
    rows = df.withColumn("_cell", cell)
    counts = rows.groupBy(date, "_cell").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(date).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(date).alias("_date"), F.col("_cell").alias("_own"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy(date, "_cell").orderBy(*order)))
    met = placed.join(before, F.col(date).eqNullSafe(F.col("_date")) & F.col("_cell").eqNullSafe(F.col("_own")))
    return met.withColumn(out, F.col("_before") + F.col("_place")).drop("_cell", "_place", "_date", "_own", "_before")


def haloed(df: DataFrame, place: Column, halo: float, size: float) -> DataFrame:
    """df with _block and _home: every row in its own block of places and, as a guest, in those that begin or end within halo.
    Rows without a place are a block of their own."""
    at = lambda x: F.floor(x / size)
    return df.withColumn("_block", F.explode_outer(F.sequence(at(place - halo), at(place + halo)))).withColumn("_home", F.col("_block").eqNullSafe(at(place)))


def at_home(df: DataFrame) -> DataFrame:
    """The blocks' own rows."""
    return df.where("_home").drop("_block", "_home")


def within(date: str = "flight_date"):
    """A window over a block."""
    return Window.partitionBy(date, "_block")


def around(df: DataFrame, out: str, value: Column, before: int, after: int, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), cell: Column | None = None, size: int = ROWS) -> DataFrame:
    """df with out: value (an aggregate) over the rows from `before` rows before to `after` rows after each row of its date."""
    placed = haloed(positions(df, date, order, cell, "_rn"), F.col("_rn") - 1, max(before, after), size)
    return at_home(placed.withColumn(out, value.over(within(date).orderBy("_rn").rowsBetween(-before, after)))).drop("_rn")


def band_join(left: DataFrame, right: DataFrame, left_at: Column, right_at: Column, within: float) -> DataFrame:
    """Pairs whose places are at most within apart, by an equi-join: places are cut into cells as wide as the band, and the right
    side is listed in its own cell and both neighbours, so that a pair meets once. Rows without a place have no partner."""
    cell = lambda x: F.floor(x / within) if within else x
    cells = F.array(*[cell(F.col("_rat")) + i for i in (-1, 0, 1)]) if within else F.array(cell(F.col("_rat")))
    listed = right.withColumn("_rat", right_at).withColumn("_rcell", F.explode(cells))
    met = left.withColumn("_lat", left_at).withColumn("_lcell", cell(F.col("_lat"))).join(listed, F.col("_lcell") == F.col("_rcell"))
    return met.where(F.abs(F.col("_lat") - F.col("_rat")) <= within).drop("_lat", "_lcell", "_rat", "_rcell")
