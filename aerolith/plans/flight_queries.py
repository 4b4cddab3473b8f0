"""Queries of flights on events: sessions of at least 60 events count as flights, so that some rows are left over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.storage import shared_path
from aerolith.functions.timekeys import epoch_seconds
from aerolith.operators import flights
from aerolith.plans import frames
from aerolith.plans.registry import query
from aerolith.streaming import sessions

LARGE, STEP, SLOTS = 60, 600.0, 200


def rows(spark, sf) -> DataFrame:
    return frames.events(spark, sf).where("value is not null").select(F.to_date("ts").alias("flight_date"), "event_id", epoch_seconds("ts").alias("at"), "value")


def spans(spark, sf) -> DataFrame:
    found = flights.sessions(rows(spark, sf).select("flight_date", "at"))
    return found.where((F.col("n_rows") >= LARGE) & (F.day(F.timestamp_seconds("start_s")) % 5 != 0)).select("start_s", "end_s")


def cut(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flights by the large sessions as markers; days without one get a flight of their own."""
    return flights.segment(rows(spark, sf), STEP, spans(spark, sf))


@query
def presence_sessions(spark, sf):
    return flights.sessions(rows(spark, sf).select("flight_date", "at"))


@query
def stream_legs(spark, sf):
    """Sessions of events that come in as a stream of files, a day each, numbered as legs; a row long after all others ends the
    last session, and its own stays open."""
    source, sink, state = shared_path(spark), shared_path(spark), shared_path(spark)
    own = rows(spark, sf).select("flight_date", "at")
    own.repartition("flight_date").drop("flight_date").write.parquet(source)
    own.agg((F.max("at") + 100 * 86_400).alias("at")).write.mode("append").parquet(source)
    stream = spark.readStream.schema("at double").option("maxFilesPerTrigger", 16).parquet(source)
    sessions.run(stream, sink, state, late="60 days")
    sessions.run(stream, sink, state, late="60 days")
    return flights.legs(spark.read.schema("start_s double, end_s double, n_rows long").parquet(sink)).select("flight_id", "date", "leg", "start_s", "end_s")


@query
def flight_legs(spark, sf):
    return flights.legs(flights.sessions(rows(spark, sf).select("flight_date", "at"))).select("flight_id", "date", "leg", "start_s", "end_s")


@query
def interval_assign(spark, sf):
    return flights.assign(rows(spark, sf).select("event_id", "at"), spans(spark, sf))


@query
def orphan_days(spark, sf):
    own = spans(spark, sf)
    return flights.orphan_spans(flights.assign(rows(spark, sf).select("event_id", "at"), own), own)


@query
def flight_table(spark, sf):
    return cut(spark, sf)[1]


@query
def flight_grid(spark, sf):
    return cut(spark, sf)[0].select("event_id", "flight_no", "sod", "slot")


@query
def dropped_rows(spark, sf):
    return flights.dropped(flights.assign(rows(spark, sf).select("event_id", "at"), spans(spark, sf)))


@query
def segment_dropped(spark, sf):
    return cut(spark, sf)[2]


@query
def envelope_select(spark, sf):
    """Marker envelopes of dates long before the data and of every second hour of it; those beside the data go."""
    own = rows(spark, sf)
    hour = F.floor(F.col("at") / 3600)
    given = own.groupBy(hour.alias("hour")).agg(F.min("at").alias("start_s"), F.max("at").alias("end_s"))
    early = given.select((F.col("start_s") - 10_000_000).alias("start_s"), (F.col("end_s") - 10_000_000).alias("end_s"))
    return flights.select_spans(given.select("start_s", "end_s").unionByName(early), own)


@query
def densify(spark, sf):
    gridded, table, _ = cut(spark, sf)
    return flights.densify(gridded, table, "value", SLOTS, -999.0)


@query
def marker_spans(spark, sf):
    """Envelopes of marker files: the first and last row by position of each event type and date."""
    from aerolith.sources.icartt import marker_envelopes

    lines = frames.events(spark, sf).select(
        F.concat(F.lit("marker_HU25_"), F.date_format("ts", "yyyyMMdd"), F.lit("_R0_L"), (F.col("user_id") % 3).cast("string"), F.lit(".ict")).alias("file"),
        F.col("event_id").alias("pos"), epoch_seconds("ts").alias("at"),
    )
    return marker_envelopes(lines)
