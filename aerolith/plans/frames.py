"""Sensor frames derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_BINS = 12


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels of one instrument suite, one row per event."""
    e = F.col("event_id")
    user = F.col("user_id")
    value = F.col("value")
    unless = lambda k, x: F.when(e % k != 0, x)
    cloudy = (F.col("event_type") == "error") & (value > 150)
    wet = (F.col("event_type") == "click") & (value > 250)
    return events(spark, sf_dir).select(
        F.to_date("ts").alias("flight_date"), "ts", "event_id", "user_id", "event_type", "value",
        unless(31, value).alias("sc450"), (value * 0.7).alias("sc550"), (value * 0.4).alias("sc700"),
        unless(37, value * 0.05).alias("abs470"), (value * 0.04).alias("abs532"), (value * 0.03).alias("abs660"),
        (20 + e * 7 % 60).cast("double").alias("rh"), ((20 + user % 10 * 5) / 100.0).alias("gamma"),
        unless(23, (65 + e % 35) / 100.0).alias("ssa550"), ((100 + user % 11 * 15) / 100.0).alias("ae"),
        F.when(e % 19 == 0, 1).when(e % 29 == 0, None).otherwise(0).alias("inlet"),
        F.when(e % 41 == 0, None).when(cloudy, value).otherwise(0.0).alias("n_cdp"),
        F.when(wet, 0.01).otherwise(0.0).alias("lwc_cdp"),
    )


def spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor frame with a size spectrum (null bins included)."""
    e = F.col("event_id")
    bins = [F.when((e + 5 * i) % 17 != 0, F.col("value") * (1 + (e + 13 * i) % 10) / 10.0) for i in range(N_BINS)]
    return sensor(spark, sf_dir).withColumn("psd", F.array(*bins))


def lag_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smoothed reference, a delayed copy of it, and an unrelated target, by row number within the date."""
    ordered = Window.partitionBy("flight_date").orderBy("ts", "event_id")
    rows = events(spark, sf_dir).select(F.to_date("ts").alias("flight_date"), "ts", "event_id", "value")
    rows = rows.withColumns({"rn": F.row_number().over(ordered), "ref_raw": F.avg("value").over(ordered.rowsBetween(-8, 8))})
    delay = F.day("flight_date") % 7 - 3
    # The delay is one of seven constants, so each is a lag of its own and no join is needed.
    delayed = F.coalesce(*[F.when(delay == k, F.lag("ref_raw", k).over(ordered) if k >= 0 else F.lead("ref_raw", -k).over(ordered)) for k in range(-3, 4)])
    e = F.col("event_id")
    return rows.select(
        "flight_date", "rn", "event_id",
        F.when(e % 53 != 0, F.col("ref_raw")).alias("ref"),
        F.when(e % 59 != 0, delayed + (e % 5).cast("double")).alias("tgt_a"),
        F.when(F.day("flight_date") % 4 != 0, F.col("value")).alias("tgt_b"),
    )
