"""Closed-form cases of row quality and windows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from aerolith.functions.nulls import nan_to_null
from aerolith.operators import qc, windows

START = dt.datetime(2021, 5, 13, 12)


def frame(spark, n=30, change=None):
    """One row a second of a clean sensor; change(i, row) alters rows."""
    rows = []
    for i in range(n):
        r = {"flight_date": START.date(), "ts": START + dt.timedelta(seconds=i), "event_id": i, "sc450": 50.0, "sc550": 35.0, "rh": 30.0, "gamma": 0.3, "ssa550": 0.95, "ae": 1.9, "inlet": 0.0, "n_cdp": 0.0, "lwc_cdp": 0.0, "abs532": 1.5}
        if change:
            change(i, r)
        rows.append(r)
    schema = "flight_date date, ts timestamp_ntz, event_id long, sc450 double, sc550 double, rh double, gamma double, ssa550 double, ae double, inlet double, n_cdp double, lwc_cdp double, abs532 double"
    return spark.createDataFrame(rows, schema)


def masked(df):
    df = qc.derive_optical(df, ("sc450", "sc550"), "rh", "gamma", wet_of="sc550").withColumn("raw", qc.cloud_raw(["n_cdp", "absent"], ["lwc_cdp"], df.columns))
    return qc.row_masks(df, qc.dilate(F.col("raw")), "inlet", "sc450_dry", "ssa550")


def test_gamma_round_trip(spark):
    df = spark.createDataFrame([(40.0, 0.4, 70.0)], "sc double, g double, rh double")
    there = df.withColumn("x", qc.gamma_adjust(F.col("sc"), F.col("g"), F.col("rh"), F.lit(20.0)))
    back = there.select(qc.gamma_adjust(F.col("x"), F.col("g"), F.lit(20.0), F.col("rh")).alias("y")).first()["y"]
    assert back == pytest.approx(40.0)


def test_dry_passes_through_at_low_humidity(spark):
    r = masked(frame(spark, 1)).first()
    assert r["sc450_dry"] == 50.0 and r["valid"]


def test_closed_form_at_high_humidity(spark):
    r = masked(frame(spark, 1, lambda i, r: r.update(rh=60.0))).first()
    assert r["sc450_dry"] == pytest.approx(50.0 / math.exp(0.3 * math.log(60 / 40)))


def test_saturated_humidity_gives_null_and_low_signal(spark):
    r = masked(frame(spark, 1, lambda i, r: r.update(rh=100.0))).first()
    assert r["sc450_dry"] is None and r["low_signal"]


def test_one_cloudy_row_spreads_five_rows_each_way(spark):
    df = masked(frame(spark, 30, lambda i, r: r.update(n_cdp=2.0) if i == 15 else None))
    assert [r["event_id"] for r in df.where("cloudy").orderBy("event_id").collect()] == list(range(10, 21))


def test_global_dilation_crosses_midnight(spark):
    rows = [(d, i, i == 9) for i in range(20) for d in [dt.date(2021, 5, 13 + i // 10)]]
    df = spark.createDataFrame(rows, "flight_date date, event_id long, raw boolean")
    found = qc.dilate_global(df, "raw", "cloudy", order=("event_id",), rows=3)
    assert sorted(r["event_id"] for r in found.where("cloudy").collect()) == list(range(6, 13))


def test_missing_values(spark):
    def change(i, r):
        r.update({0: {"ssa550": float("nan")}, 1: {"sc450": float("nan")}, 2: {"inlet": float("nan")}, 3: {"n_cdp": float("nan")}}.get(i, {}))

    df = masked(nan_to_null(frame(spark, 4, change)))
    assert [r["valid"] for r in df.orderBy("event_id").collect()] == [True, False, False, True]


def test_flag_bits(spark):
    df = masked(frame(spark, 1, lambda i, r: r.update(n_cdp=5.0, inlet=1.0, sc450=1.0, ssa550=0.5)))
    assert df.select(qc.row_flag().alias("f")).first()["f"] == 15


def flags(df, mode="relative", limit=0.3):
    w = windows.aggregate(df, ("sc450_dry", "sc550", "abs532", "ae"))
    w = w.withColumn("f", windows.quality_flag("ae", ("sc450_dry", "sc550", "abs532"), limit=limit, mode=mode))
    return windows.bounds(w).orderBy("window_start").collect()


def test_two_clean_windows(spark):
    rows = flags(masked(frame(spark, 120)))
    assert [(r["n_valid"], r["f"]) for r in rows] == [(60, 0), (60, 0)]
    assert rows[0]["time_centre"] == rows[0]["time_start"] + 30


def test_gap_gives_no_windows(spark):
    df = frame(spark, 60).unionByName(frame(spark, 60).withColumn("ts", F.expr("ts + INTERVAL 6 HOURS")))
    assert len(flags(masked(df))) == 2


def test_cloudy_part(spark):
    rows = flags(masked(frame(spark, 60, lambda i, r: r.update(n_cdp=9.0) if i < 55 else None)))
    assert rows[0]["n_cloudy"] == 60 and rows[0]["f"] & windows.TOO_FEW


def test_unstable_exponent(spark):
    rows = flags(masked(frame(spark, 60, lambda i, r: r.update(ae=0.1 if i % 2 else 3.0))))
    assert rows[0]["f"] == windows.UNSTABLE
    assert flags(masked(frame(spark, 60, lambda i, r: r.update(ae=0.1 if i % 2 else 3.0))), "absolute", 5.0)[0]["f"] == 0


def test_missing_optics(spark):
    assert flags(masked(frame(spark, 60, lambda i, r: r.update(abs532=None))))[0]["f"] == windows.MISSING


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        windows.quality_flag("ae", (), mode="other")


def test_sparse_bin_is_null(spark):
    df = masked(frame(spark, 60)).withColumn("psd", F.array(F.lit(100.0), F.when(F.col("event_id") < 9, 100.0)))
    assert windows.spectrum_means(df, "psd", 2).first()["psd"] == [100.0, None]


def test_empty_table(spark):
    df = masked(frame(spark, 1)).limit(0)
    assert flags(df) == [] and qc.row_totals(df).first()["n_rows"] == 0


def test_stream_equals_batch(spark, tmp_path):
    from aerolith.streaming.windows import aggregate

    df = masked(frame(spark, 120)).withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = aggregate(stream, ("ae",)).writeStream.outputMode("complete").format("memory").queryName("windows_out").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert [r["n_valid"] for r in spark.table("windows_out").orderBy("window_start").collect()] == [60, 60]
