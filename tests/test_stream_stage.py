"""Sessions on a stream, stage tables with versions, and bucketed joins."""

import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import flights, retrieval
from aerolith.sources import products, stages
from aerolith.streaming import sessions


def batch(spark, rows, gap):
    df = spark.createDataFrame(rows, "at double, k string").withColumn("flight_date", F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd"))
    return sorted(tuple(r) for r in flights.sessions(df.select("flight_date", "at"), gap).select("start_s", "end_s", "n_rows").collect())


def stream_of(spark, path, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "at double, k string").coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema("at double, k string").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def found(spark, path, schema="start_s double, end_s double, n_rows long"):
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(f"{path}/out").collect())


def test_sessions_with_late_rows_are_those_of_the_batch(spark, tmp_path):
    """Rows up to an hour late join, connect and open sessions; a gap of exactly the limit and one a little longer; over midnight."""
    rnd = random.Random(5)
    at = 1_704_060_000.0
    rows = []
    for _ in range(300):
        at += rnd.choice([1, 5, 60, 600, 600.5, 1800, 0])
        rows.append((at, "a"))
    arriving = sorted(rows, key=lambda r: r[0] + rnd.random() * 3000)
    stream = stream_of(spark, str(tmp_path), [arriving[i : i + 60] for i in range(0, 300, 60)] + [[(at + 10**6, "z")]])
    sessions.run(stream, f"{tmp_path}/out", f"{tmp_path}/state", 600, "1 hour")
    assert found(spark, tmp_path) == batch(spark, rows, 600)


def test_later_rows_are_dropped_and_open_sessions_wait(spark, tmp_path):
    first = [[(1000.0, "a"), (1010.0, "b"), (None, "a")], [(9000.0, "a")]]
    stream = stream_of(spark, str(tmp_path), first)
    sessions.run(stream, f"{tmp_path}/out", f"{tmp_path}/state", 60, "10 minutes", by=("k",))
    schema = "k string, start_s double, end_s double, n_rows long"
    assert found(spark, tmp_path, schema) == [("a", 1000.0, 1000.0, 1), ("b", 1010.0, 1010.0, 1)]
    more = stream_of(spark, str(tmp_path), [[(1020.0, "a"), (9030.0, "a")], [(20_000.0, "b")]])
    sessions.run(more, f"{tmp_path}/out", f"{tmp_path}/state", 60, "10 minutes", by=("k",))
    assert found(spark, tmp_path, schema)[1] == ("a", 9000.0, 9030.0, 2) and len(found(spark, tmp_path, schema)) == 3


def test_stage_versions(spark, tmp_path):
    stage = stages.Stage(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError):
        stage.read()
    make = lambda rows: spark.createDataFrame(rows, "flight_date string, v long")
    rows = lambda df: sorted(tuple(r) for r in df.select("flight_date", "v").collect())
    assert stage.replace(make([("2024-01-01", 1), ("2024-01-02", 2), ("2024-02-01", 9)]), ["2024-01-01", "2024-01-02"]) == 1
    old = stage.read()
    assert rows(old) == [("2024-01-01", 1), ("2024-01-02", 2)]  # other dates' rows aren't part of the commit
    assert stage.replace(make([("2024-01-02", 5)]), ["2024-01-01", "2024-01-02"]) == 2
    assert rows(stage.read()) == [("2024-01-02", 5)] and rows(old) == rows(stage.read(1)) == [("2024-01-01", 1), ("2024-01-02", 2)]
    # A run that fails before its commit is never seen.
    with pytest.raises(Exception):
        stage.replace(make([("2024-01-02", 6)]).withColumn("v", F.raise_error(F.lit("lost")).cast("long")), ["2024-01-02"])
    assert stage.version() == 2 and rows(stage.read()) == [("2024-01-02", 5)]
    # Of two writers that start from one version one commits.
    other = stages.Stage(spark, str(tmp_path / "s"))
    other.version = lambda: 1
    with pytest.raises(RuntimeError):
        other.replace(make([("2024-01-01", 7)]), ["2024-01-01"])
    assert rows(stage.read()) == [("2024-01-02", 5)]


def test_rerun_makes_neighbours_again(spark, tmp_path):
    """Sums over a day and its neighbours: a changed day changes three."""
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    source = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "flight_date string, v long")
    asked = []

    def compute(df):
        asked.append(sorted(r["flight_date"] for r in df.collect()))
        near = df.select(F.explode(F.sequence(F.date_sub("flight_date", 1), F.date_add("flight_date", 1))).alias("d"), "v")
        return near.select(F.col("d").cast("string").alias("flight_date"), "v").groupBy("flight_date").agg(F.sum("v").alias("v")).join(df.select("flight_date"), "flight_date")

    stage = stages.Stage(spark, str(tmp_path / "s"))
    stage.replace(compute(source), days)
    changed = source.withColumn("v", F.when(F.col("flight_date") == "2024-01-05", 100).otherwise(F.col("v")))
    assert stages.rerun(stage, changed, ["2024-01-05"], compute) == 2
    assert sorted(tuple(r) for r in stage.read().select("flight_date", "v").collect()) == sorted(tuple(r) for r in compute(changed).collect())
    assert asked[1] == days[2:7] and len(set(stage.runs().values())) == 2


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    keys = ["flight_date", "window_start"]
    rows = spark.range(2000).selectExpr("string(date_add(date'2024-01-01', int(id % 9))) flight_date", "id % 50 window_start", "id")
    own = spark.range(50).selectExpr("string(date_add(date'2024-01-01', int(id % 9))) flight_date", "id window_start", "id * 2 value")
    a, b = (products.write_bucketed(df, f"bucketed_{n}", keys, 4, str(tmp_path / n)) for n, df in (("a", rows), ("b", own)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (flights.broadcast_windows(a, b, keys, ["value"]), retrieval.assemble(b, a, keys)):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(map(tuple, flights.broadcast_windows(a, b, keys, ["value"]).collect()), key=repr) == sorted(map(tuple, flights.broadcast_windows(rows, own, keys, ["value"]).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")
