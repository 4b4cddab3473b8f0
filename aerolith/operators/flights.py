"""Flights: sessions of present data, interval assignment, renumbering, and the (flight, slot) grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.storage import written

GAP_S, PAD_S = 1200, 120


def sessions(rows: DataFrame, gap: float = GAP_S) -> DataFrame:
    """(start_s, end_s, n_rows) of maximal stretches of rows (flight_date, at) without a gap over gap seconds (under a day).
    Islands are found within each date; a window over one row for each date tells which first islands go on with the
    date before, and the islands of a session are then added up."""
    if gap >= 86_400:
        raise ValueError("gaps must be shorter than a day")
    ordered = Window.partitionBy("flight_date").orderBy("at")
    opens = F.coalesce(F.col("at") - F.lag("at").over(ordered) > gap, F.lit(True))
    numbered = rows.withColumn("_o", opens.cast("int")).withColumn("_i", F.sum("_o").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy("flight_date", "_i").agg(F.min("at").alias("start_s"), F.max("at").alias("end_s"), F.count("*").alias("n_rows"))
    within = Window.partitionBy("flight_date")
    # By date: where its last island starts and ends, if that isn't its first one.
    islands = islands.withColumns({"_last": F.max("start_s").over(within), "_end": F.max("end_s").over(within)})
    along = Window.orderBy("start_s")
    first = islands.where("_i = 1").withColumn("_on", F.coalesce(F.col("start_s") - F.lag("_end").over(along) <= gap, F.lit(False)))
    # A date's last island begins where it starts itself, or where the session began that its only island goes on with.
    begins = F.when((F.col("_last") > F.col("start_s")) | ~F.col("_on"), F.col("_last"))
    carried = first.withColumn("_b", F.last(begins, True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    keyed = carried.withColumn("_s", F.when(F.col("_on"), F.lag("_b").over(along)).otherwise(F.col("start_s"))).select("_s", "start_s", "end_s", "n_rows")
    others = islands.where("_i > 1").select(F.col("start_s").alias("_s"), "start_s", "end_s", "n_rows")
    return keyed.unionByName(others).groupBy("_s").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("n_rows").alias("n_rows")).drop("_s")


def legs(spans: DataFrame) -> DataFrame:
    """Spans with the date of their start, a leg number where a date has several (else 0), and an id."""
    spans = spans.withColumn("date", F.date_format(F.timestamp_seconds("start_s"), "yyyy-MM-dd"))
    by_date = Window.partitionBy("date")
    several = F.count("*").over(by_date) > 1
    leg = F.when(several, F.row_number().over(by_date.orderBy("start_s"))).otherwise(0)
    out = spans.withColumn("leg", leg)
    return out.withColumn("flight_id", F.when(F.col("leg") > 0, F.concat("date", F.lit("_L"), F.col("leg").cast("string"))).otherwise(F.col("date")))


def padded(spans: DataFrame, pad: float = PAD_S) -> DataFrame:
    """Spans with the padded ends lo and hi, clipped at the midpoint between neighbours that would overlap, and next_lo.
    Spans are flights, a few a day, so one window over all of them is small."""
    along = Window.orderBy("start_s")
    before, after = F.lag("end_s").over(along), F.lead("start_s").over(along)
    lo = F.when(before + pad > F.col("start_s") - pad, (before + F.col("start_s")) / 2).otherwise(F.col("start_s") - pad)
    hi = F.when(F.col("end_s") + pad > after - pad, (F.col("end_s") + after) / 2).otherwise(F.col("end_s") + pad)
    return spans.withColumns({"lo": lo, "hi": hi}).withColumn("next_lo", F.lead("lo").over(along))


def assign(rows: DataFrame, spans: DataFrame, pad: float = PAD_S) -> DataFrame:
    """rows (with at) and the start_s of the span that holds them; a shared end belongs to the later span; null outside.
    Spans are listed under each day they touch, so that rows meet the spans of their own day only. A row meets one span
    at most, so repeated rows stay as they are and nothing is shuffled for them."""
    day = lambda x: F.floor(x / 86_400)
    listed = padded(spans, pad).select(F.col("start_s").alias("span_s"), "lo", "hi", "next_lo", F.explode(F.sequence(day(F.col("lo")), day(F.col("hi")))).alias("_d")).where("hi >= lo")
    before_next = F.coalesce(F.col("at") < F.col("next_lo"), F.lit(True))
    met = rows.withColumn("_day", day(F.col("at"))).join(listed, (F.col("_day") == F.col("_d")) & (F.col("at") >= F.col("lo")) & (F.col("at") <= F.col("hi")) & before_next, "left")
    return met.select(*rows.columns, "span_s")


def segment(rows: DataFrame, step: float, markers: DataFrame | None = None, gap: float = GAP_S, pad: float = PAD_S) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (flight_date, at) cut into flights: (rows on the grid, flights, rows dropped).

    Flights are the marker envelopes (start_s, end_s) that overlap the data, else the sessions of the rows; days whose rows
    no envelope claims get one of their own. Spans, a few a day, are written once, so that the rows are read three times: for
    the spans, for the orphan days and for the result."""
    own = written(select_spans(markers, rows, gap) if markers is not None else sessions(rows.select("flight_date", "at"), gap).select("start_s", "end_s"))
    orphans = orphan_spans(assign(rows.select("at"), own, pad), own)
    every = written(own.unionByName(orphans.select("start_s", "end_s")))
    given = assign(rows, every, pad)
    flights = written(flight_table(given, every))
    return grid(given, flights, step), flights, dropped(given)


def orphan_spans(assigned: DataFrame, spans: DataFrame) -> DataFrame:
    """One span for each day that has unclaimed rows but no span: from the first to the last of them."""
    day = F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd")
    left = assigned.where("span_s is null").select(day.alias("date"), "at")
    taken = spans.select(F.date_format(F.timestamp_seconds("start_s"), "yyyy-MM-dd").alias("date")).distinct()
    return left.join(taken, "date", "left_anti").groupBy("date").agg(F.min("at").alias("start_s"), F.max("at").alias("end_s"))


def flight_table(assigned: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans that own a row, numbered from 1 by takeoff, with takeoff and landing as seconds of the takeoff day."""
    owning = assigned.where("span_s is not null").groupBy("span_s").agg(F.count("*").alias("n_rows"))
    midnight = F.floor(F.col("start_s") / 86_400) * 86_400
    kept = spans.select("start_s", "end_s").join(owning, F.col("start_s") == F.col("span_s")).drop("span_s")
    return kept.select(F.row_number().over(Window.orderBy("start_s")).alias("flight_no"), "start_s", "end_s", "n_rows", midnight.alias("midnight_s"), (F.col("start_s") - midnight).alias("takeoff_sod"), (F.col("end_s") - midnight).alias("landing_sod"))


def grid(assigned: DataFrame, flights: DataFrame, step: float) -> DataFrame:
    """Rows with flight_no, seconds since the takeoff day's midnight (over 86400 past it) and slot."""
    known = assigned.join(flights.select("flight_no", "midnight_s", F.col("start_s").alias("span_s")), "span_s")
    sod = F.col("at") - F.col("midnight_s")
    return known.withColumns({"sod": sod, "slot": F.rint(sod / step).cast("long")}).drop("span_s", "midnight_s")


def dropped(assigned: DataFrame) -> DataFrame:
    """Rows outside all flights: count and percent."""
    n = F.count_if(F.col("span_s").isNull())
    return assigned.agg(F.count("*").alias("n_rows"), n.alias("n_dropped"), F.try_divide(n * 100.0, F.count("*")).alias("percent_dropped"))


def densify(gridded: DataFrame, flights: DataFrame, value: str, n_slots: int, fill: float) -> DataFrame:
    """(flight_no, slot, value) for every slot of every flight; the last row of a slot counts, fill where there is none."""
    axis = flights.select("flight_no", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slots - 1).cast("long"))).alias("slot"))
    last = gridded.groupBy("flight_no", "slot").agg(F.max_by(value, "at").alias(value))
    return axis.join(last, ["flight_no", "slot"], "left").withColumn(value, F.coalesce(value, F.lit(fill)))


def broadcast_windows(rows: DataFrame, windows: DataFrame, key: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """Each row with its window's values; null where it has no window. Where both are bucketed by the key, nothing is shuffled."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows.join(windows.select(*keys, *values), keys, "left")


def select_spans(spans: DataFrame, rows: DataFrame, gap: float = GAP_S) -> DataFrame:
    """The given envelopes (start_s, end_s) that overlap the rows' time range; sessions of the rows if none does."""
    limits = rows.agg(F.min("at").alias("_lo"), F.max("at").alias("_hi"))
    inside = spans.crossJoin(F.broadcast(limits)).where((F.col("end_s") >= F.col("_lo")) & (F.col("start_s") <= F.col("_hi")))  # one row
    kept = inside.select("start_s", "end_s")
    return sessions(rows.select("flight_date", "at"), gap).select("start_s", "end_s") if kept.isEmpty() else kept
