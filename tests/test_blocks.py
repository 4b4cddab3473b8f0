"""Operators over rows by position: a table of one date is many tasks, with the results of a window over the date."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.functions.storage import written
from aerolith.operators import align, blocks, merge, qc, report, windows

DATE = lambda: Window.partitionBy("flight_date").orderBy("ts", "event_id")


@pytest.fixture(scope="module")
def one_date(spark):
    """20,000 rows of a single date, four seconds apart, with equal times, gaps and a second, short date."""
    i = F.col("id")
    at = F.when(i % 10 == 1, i - 1).otherwise(i) * 4
    rows = spark.range(20_000).select(
        F.when(i < 19_990, "2024-01-01").otherwise("2024-01-02").alias("flight_date"), F.timestamp_seconds(1_704_067_200 + at).cast("timestamp_ntz").alias("ts"), i.alias("event_id"),
        (i % 397 == 0).alias("flag"), F.when(i % 13 != 0, F.sin(i / 50.0) * 40 + i % 7).alias("x"), F.when(i % 17 != 0, F.sin((i - 4) / 50.0) * 40).alias("y"), at.cast("double").alias("at"),
    )
    return written(rows)


@pytest.fixture()
def spread_out(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def test_positions(one_date, spread_out):
    found = blocks.positions(one_date)
    assert rows(found.select("event_id", "rn")) == rows(one_date.select("event_id", F.row_number().over(DATE()).alias("rn")))
    assert spread_out(found.where("flight_date = '2024-01-01'")) == 4


def test_positions_by_number_and_by_text(one_date):
    for order in (F.col("event_id"), F.lpad(F.col("event_id").cast("string"), 6, "0")):
        some = one_date.where("event_id < 9000").withColumn("o", order)
        found = blocks.positions(some, order=("o",)).select("event_id", "rn")
        assert rows(found) == rows(some.select("event_id", (F.col("event_id") + 1).alias("rn")))


@pytest.mark.parametrize("size", [5, 64, 8192])
def test_dilation(one_date, size):
    found = qc.dilated(one_date, F.col("flag"), "cloudy", size=size).select("event_id", "cloudy")
    assert rows(found) == rows(one_date.select("event_id", qc.dilate(F.col("flag")).alias("cloudy")))


@pytest.mark.parametrize("width", [1, 10, 11])
def test_moving_mean(one_date, spread_out, width):
    found = report.moving_mean(one_date, "x", width, "smooth", size=100)
    assert found.columns == [*one_date.columns, "smooth"] and spread_out(found) == 4
    assert rows(found.select("event_id", "smooth")) == rows(one_date.select("event_id", F.avg("x").over(DATE().rowsBetween(-(width // 2), width - width // 2 - 1)).alias("smooth")))


def test_lag_pairs(one_date, spread_out):
    numbered = written(blocks.positions(one_date))
    found = align._led(numbered, "x", ["y"], "flight_date", "rn", 30, 90, size=64)
    assert spread_out(found) == 4 and found.count() == 19_990 - 60  # the short date has none
    ordered = Window.partitionBy("flight_date").orderBy("rn")
    wanted = numbered.select("rn", *[F.lead("y", k).over(ordered).alias(f"k{k}") for k in (-30, 0, 30)]).where("rn > 30 and rn <= 19960")
    assert rows(found.select("rn", F.col("all")[0].alias("a"), F.col("all")[30].alias("b"), F.col("all")[60].alias("c"))) == rows(wanted)


@pytest.mark.parametrize("fill", [merge.fill_linear, merge.fill_nearest])
def test_gap_filling(one_date, fill):
    """Blocks of any length give what one block for the date gives; gaps at most, just over and far over the limit."""
    thin = written(one_date.where("event_id % 10 <> 1").withColumn("v", F.when((F.col("event_id") % 50 < 20) | (F.col("event_id") % 700 == 0), F.col("x"))).withColumn("slot_s", F.col("at")))
    whole, parts = (fill(thin, "v", "filled", 124.0, size=s).select("event_id", "filled") for s in (10**9, 1))
    assert rows(whole) == rows(parts) and parts.where("filled is not null").count() > thin.where("v is not null").count()


def test_rows_without_a_place_stay(one_date):
    some = one_date.limit(50).withColumn("slot_s", F.when(F.col("event_id") % 5 != 0, F.col("at")))
    assert merge.fill_linear(some, "x", "filled", 60.0).count() == 50


def test_best_window(one_date):
    whole, parts = (report.best_window(one_date, "x", ("y",), 8, size=s) for s in (10**9, 16))
    assert rows(whole) == rows(parts) and parts.count() == 2


def test_best_window_carries_gaps_on(spark):
    """Against all neighbours one by one: equal places, NaN, null dates and places; no frame that slides over a neighbourhood."""
    rnd = random.Random(6)
    value = lambda k: None if rnd.random() < k else float("nan") if rnd.random() < 0.01 else float(rnd.randrange(50))
    made = [(rnd.choice(["a", "b", None]), None if rnd.random() < 0.02 else rnd.randrange(2000) / 2, value(0.02), value(0.05), value(0.1)) for _ in range(900)]
    df = spark.createDataFrame(made, "flight_date string, at double, x double, y double, z double")
    wanted = []
    for date in ("a", "b", None):
        own = [r for r in made if r[0] == date]
        known = sorted((r[2] for r in own if r[2] is not None), key=lambda v: (v != v, v))
        median = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
        best = []
        for _, at, x, *_ in own:
            near = [r for r in own if None not in (at, r[1]) and at - 4 <= r[1] <= at + 4]
            full = [all(r[i] is not None for r in near) for i in (2, 3, 4)]
            if near and full[0] and (x != x or x >= median):
                best.append((1 if full[1] and full[2] else 2 if full[1] else 3, x == x, 0 if x != x else -x, at, x))
        wanted += [(date, b[0], b[3], b[4]) for b in [min(best)]]
    found = report.best_window(df, "x", ("y", "z"), 4, size=64)
    assert repr(rows(found)) == repr(sorted(wanted, key=repr))
    assert "(RangeFrame, -" not in found._jdf.queryExecution().analyzed().toString()


def test_native_step(spark, one_date):
    assert rows(windows.native_step(one_date, size=32)) == [("2024-01-01", 4.0), ("2024-01-02", 4.0)]
    assert [r.step_s for r in windows.native_step(one_date.limit(1)).collect()] == [1.0]
