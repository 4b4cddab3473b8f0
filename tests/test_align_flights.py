"""Closed-form cases of clock alignment and flights."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from aerolith.operators import align, flights

DAY = dt.date(2021, 5, 13)


def series(spark, n=400, delay=4, missing=()):
    value = lambda i: math.sin(i / 9.0) + 0.3 * math.sin(i / 2.3)
    rows = [(DAY, i + 1, value(i), None if i in missing else value(i - delay), 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "flight_date date, rn long, ref double, tgt double, flat double")


@pytest.mark.parametrize("delay", [-6, 0, 4])
def test_known_delay_is_found(spark, delay):
    d = align.diagnose(series(spark, delay=delay), "ref", {"g": "tgt"}).first()
    assert d["optimal_shift_s"] == delay and d["decision"] == "SHIFT"


def test_short_dates_give_no_pairs(spark):
    assert align.lag_pairs(series(spark, 89), "ref", {"g": "tgt"}).count() == 0
    assert align.lag_pairs(series(spark, 90), "ref", {"g": "tgt"}).count() == 30 * 61


def test_constant_series_has_no_correlation(spark):
    d = align.diagnose(series(spark), "ref", {"g": "flat"}).first()
    assert d["peak_r"] is None and d["decision"] == "SKIP"


def curve(spark, values):
    return spark.createDataFrame([(DAY, "g", i - 30, 400, v, v) for i, v in enumerate(values)], "flight_date date, grp string, lag int, n_valid long, corr double, sm double")


def test_peak_at_the_edge_has_no_half_width(spark):
    shape = align.shapes(curve(spark, [i / 60 for i in range(61)])).first()
    assert shape["optimal_shift_s"] == 30 and shape["monotonic_halfwidth_s"] == 0 and shape["left_halfwidth_s"] == 60


def test_half_width_stops_at_a_rise(spark):
    values = [1 - abs(i - 30) / 60 for i in range(61)]
    values[20] = 0.9
    shape = align.shapes(curve(spark, values)).first()
    assert (shape["left_halfwidth_s"], shape["right_halfwidth_s"]) == (9, 30)
    assert shape["second_peak_r"] == pytest.approx(0.9)


def test_interpolation_is_flat_at_the_ends(spark):
    values = [None, 1.0, None, 3.0, None]
    df = spark.createDataFrame([(DAY, "g", i, v) for i, v in enumerate(values)], "flight_date date, grp string, lag int, corr double")
    assert [r["filled"] for r in align.interpolated(df).orderBy("lag").collect()] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_smoothing_keeps_a_constant(spark):
    df = curve(spark, [0.5] * 61).withColumn("filled", F.col("corr")).drop("sm")
    assert all(r["sm"] == pytest.approx(0.5) for r in align.smoothed(df).collect())


def test_shift_moves_rows_and_leaves_nulls(spark):
    df = series(spark, 100).select("flight_date", "rn", "tgt", "flat")
    decisions = spark.createDataFrame([(DAY, "g", 3, "SHIFT"), (DAY, "h", 5, "SKIP")], "flight_date date, grp string, optimal_shift_s int, decision string")
    before = {r["rn"]: r["tgt"] for r in df.collect()}
    after = {r["rn"]: r for r in align.apply_shift(df, decisions, {"g": ["tgt"], "h": ["flat"]}).collect()}
    assert all(after[r]["tgt"] == before.get(r + 3) and after[r]["flat"] == 1.0 for r in before)


def test_reasons_are_listed(spark):
    df = spark.createDataFrame([(10, None, 2)], "n_valid long, peak_r double, monotonic_halfwidth_s int")
    assert align.decide(df).first()["reason"] == "n_valid=10<300; peak_r<0.2; monotonic_halfwidth_s<5"


def test_pivot_takes_apply_for_shift(spark):
    rows = [(DAY, "a", 4, "APPLY", 0.9, 400, 9, ""), (DAY, "b", 2, "SKIP", 0.1, 400, 1, "peak_r<0.2")]
    df = spark.createDataFrame(rows, "flight_date date, grp string, optimal_shift_s int, decision string, peak_r double, n_valid long, monotonic_halfwidth_s int, reason string")
    r = align.provenance(df, ("a", "b")).first()
    assert (r["a_applied_shift_s"], r["a_decision_code"], r["b_applied_shift_s"], r["b_decision_code"]) == (4.0, 1, 0.0, 0)


def seconds(spark, *ranges):
    rows = [(dt.date(1970, 1, 1) + dt.timedelta(days=t // 86400), t, float(t)) for a, b in ranges for t in range(a, b, 60)]
    return spark.createDataFrame([(d, i, float(t), v) for i, (d, t, v) in enumerate(rows)], "flight_date date, event_id long, at double, value double")


def test_sessions_split_only_over_the_gap(spark):
    df = seconds(spark, (0, 600), (540 + 1200, 2400), (2340 + 1260, 4200))
    assert sorted((r["start_s"], r["end_s"]) for r in flights.sessions(df).collect()) == [(0.0, 2340.0), (3600.0, 4140.0)]


def test_two_legs_on_a_day_and_one_over_midnight(spark):
    df = seconds(spark, (3600, 7200), (36000, 40000), (86400 + 80000, 2 * 86400 + 3600))
    legs = flights.legs(flights.sessions(df)).orderBy("start_s").collect()
    assert [r["flight_id"] for r in legs] == ["1970-01-01_L1", "1970-01-01_L2", "1970-01-02"]
    spans = flights.sessions(df)
    given = flights.assign(df.select("event_id", "at", "value"), spans)
    table = flights.flight_table(given, spans)
    assert flights.grid(given, table, 60.0).agg(F.max("sod")).first()[0] > 86400


def test_padded_spans_meet_at_the_midpoint_and_ties_go_later(spark):
    spans = spark.createDataFrame([(1000.0, 2000.0), (2100.0, 3000.0)], "start_s double, end_s double")
    rows = spark.createDataFrame([(i, float(t)) for i, t in enumerate((879, 880, 2049, 2050, 3120, 3121))], "event_id long, at double")
    assert [r["span_s"] for r in flights.assign(rows, spans).orderBy("event_id").collect()] == [None, 1000.0, 1000.0, 2100.0, 2100.0, None]


def test_orphan_day_gets_a_span_but_a_claimed_day_does_not(spark):
    spans = spark.createDataFrame([(1000.0, 2000.0)], "start_s double, end_s double")
    rows = spark.createDataFrame([(0, 1500.0), (1, 50000.0), (2, 90000.0), (3, 95000.0)], "event_id long, at double")
    found = flights.orphan_spans(flights.assign(rows, spans), spans).collect()
    assert [(r["start_s"], r["end_s"]) for r in found] == [(90000.0, 95000.0)]


def test_envelopes_outside_the_data_give_way_to_sessions(spark):
    df = seconds(spark, (0, 600), (5000, 6000))
    spans = spark.createDataFrame([(500.0, 900.0), (90000.0, 91000.0)], "start_s double, end_s double")
    assert [tuple(r) for r in flights.select_spans(spans, df).collect()] == [(500.0, 900.0)]
    assert flights.select_spans(spans.where("start_s > 1000"), df).count() == 2


def test_each_reason_of_the_diagnostics(spark):
    """A date that is too short, a group without a candidate, an empty target and a weak one."""
    rows = series(spark, 400).unionByName(series(spark, 60).withColumn("flight_date", F.lit(DAY + dt.timedelta(days=1))))
    df = rows.withColumns({"empty": F.lit(None).cast("double"), "noise": F.sin(F.col("rn") * F.col("rn"))})
    candidates = {"good": ("missing", "tgt"), "none": ("x", "y"), "empty": ("empty",), "noise": ("noise",)}
    table = align.diagnostics_table(df, "ref", candidates, {"good": ("tgt", "flat", "other"), "none": ("tgt",)})
    found = {(r["flight_date"], r["grp"]): r for r in table.collect()}
    assert len(found) == 8
    good = found[DAY, "good"]
    assert (good["alignment_variable"], good["decision"], good["reason"], good["n_vars_shifted"], good["optimal_shift_s"]) == ("tgt", "SHIFT", "", 2, 4)
    assert found[DAY, "none"]["alignment_variable"] == "x|y" and found[DAY, "none"]["reason"] == "no alignment_variable candidate present in DataFrame"
    assert found[DAY, "empty"]["reason"] == "n_valid=0<300; peak_r<0.2; monotonic_halfwidth_s<5"
    assert "peak_r<0.2" in found[DAY, "noise"]["reason"] and found[DAY, "noise"]["n_valid"] == 340
    short = DAY + dt.timedelta(days=1)
    assert {found[short, g]["reason"] for g in ("good", "empty", "noise")} == {"insufficient data for cross-correlation"}
    assert found[short, "none"]["reason"] == "no alignment_variable candidate present in DataFrame" and found[short, "good"]["n_valid"] == 0


def test_lag_curves_are_the_correlation_of_the_pairs(spark):
    df = series(spark, 200, missing=(50, 51, 120))
    targets = {"g": "tgt", "h": "flat"}
    shown = lambda x: sorted((r["grp"], r["lag"], r["n_valid"], None if r["corr"] is None else round(r["corr"], 9), None if r["dot"] is None else round(r["dot"], 9)) for r in x.collect())
    assert shown(align.lag_curves(df, "ref", targets)) == shown(align.correlation(align.lag_pairs(df, "ref", targets)))


def test_shift_keeps_other_columns_and_row_numbers(spark):
    df = series(spark, 50).withColumn("name", F.concat(F.lit("n"), "rn"))
    decisions = spark.createDataFrame([(DAY, "g", -2, "SHIFT"), (DAY, "h", 4, "SHIFT")], "flight_date date, grp string, optimal_shift_s int, decision string")
    before = {r["rn"]: r for r in df.collect()}
    after = align.apply_shift(df, decisions, {"g": ["tgt"], "h": ["ref"]})
    assert after.columns == df.columns and after.count() == 50
    for r in after.collect():
        assert r["name"] == f"n{r['rn']}" and r["flat"] == 1.0
        assert r["tgt"] == (before[r["rn"] - 2]["tgt"] if r["rn"] > 2 else None) and r["ref"] == (before[r["rn"] + 4]["ref"] if r["rn"] <= 46 else None)


def test_repeated_rows_are_each_assigned(spark):
    spans = spark.createDataFrame([(1000.0, 2000.0)], "start_s double, end_s double")
    rows = spark.createDataFrame([(1, 1500.0)] * 3 + [(2, 9e4)] * 2, "event_id long, at double")
    assert sorted((r["event_id"], r["span_s"]) for r in flights.assign(rows, spans).collect()) == [(1, 1000.0)] * 3 + [(2, None)] * 2


def test_sessions_over_several_dates(spark):
    """A session over three dates, the one between with a single island; another starts on the last date."""
    df = seconds(spark, (80_000, 86_400), (86_400, 2 * 86_400), (2 * 86_400, 2 * 86_400 + 3600), (2 * 86_400 + 50_000, 2 * 86_400 + 60_000), (4 * 86_400, 4 * 86_400 + 600))
    found = sorted((r["start_s"], r["end_s"]) for r in flights.sessions(df).collect())
    assert found == [(80_000.0, 2 * 86_400 + 3540.0), (2 * 86_400 + 50_000.0, 2 * 86_400 + 59_960.0), (4 * 86_400.0, 4 * 86_400 + 540.0)]
    with pytest.raises(ValueError):
        flights.sessions(df, 90_000)


def test_segmentation(spark):
    """Marker envelopes drop the rows between; a day without an envelope gets a flight; without any, sessions do."""
    df = seconds(spark, (3600, 7200), (36_000, 40_000), (86_400 + 5000, 86_400 + 9000))
    markers = spark.createDataFrame([(3600.0, 7140.0)], "start_s double, end_s double")
    gridded, table, lost = flights.segment(df, 60.0, markers)
    assert [(r["flight_no"], r["start_s"]) for r in table.orderBy("flight_no").collect()] == [(1, 3600.0), (2, 86_400 + 5000.0)]
    assert lost.first()["n_dropped"] == 67 and gridded.count() == df.count() - 67
    assert flights.segment(df, 60.0)[1].count() == 3 and flights.segment(df, 60.0, markers.where("start_s > 1e9"))[1].count() == 3
