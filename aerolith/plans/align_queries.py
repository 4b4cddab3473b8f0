"""Queries of clock alignment on the lag frame (200 valid points suffice: dates have about 330 rows at the small scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators import align, spectra
from aerolith.plans import frames
from aerolith.plans.registry import query

TARGETS, LEAST = {"a": "tgt_a", "b": "tgt_b"}, 200
#: A third group has no candidate among the columns; dates under ROWS rows are too short (a few are, at the small scale).
CANDIDATES = {"a": ("absent_a", "tgt_a", "tgt_b"), "b": ("tgt_b",), "c": ("absent_c", "absent_d")}
VARIABLES, ROWS = {"a": ("tgt_a", "ref", "event_id"), "b": ("tgt_b", "absent_b"), "c": ("tgt_b",)}, 320
KEY = list(align.KEY)


def curve(spark, sf) -> DataFrame:
    return align.lag_curves(frames.lag_pairs(spark, sf), "ref", TARGETS)


def smooth(spark, sf) -> DataFrame:
    return align.smoothed(align.interpolated(curve(spark, sf)))


def table(spark, sf) -> DataFrame:
    return align.diagnostics_table(frames.lag_pairs(spark, sf), "ref", CANDIDATES, VARIABLES, LEAST, ROWS)


@query
def bin_sum_half(spark, sf):
    return frames.spectrum(spark, sf).select("flight_date", "event_id", spectra.sum_if_half(F.col("psd")).alias("total"))


@query
def bin_sum_min1(spark, sf):
    return frames.spectrum(spark, sf).select("flight_date", "event_id", spectra.sum_if_any(F.col("psd")).alias("total"))


@query
def lag_pairs(spark, sf):
    """All pairs, summed per lag so that the result stays small."""
    pairs = align.lag_pairs(frames.lag_pairs(spark, sf), "ref", TARGETS)
    return pairs.groupBy(*KEY, "lag").agg(F.count("*").alias("n"), F.round(F.sum("r"), 4).alias("sum_r"), F.round(F.sum("t"), 4).alias("sum_t"))


@query
def lag_correlation(spark, sf):
    return curve(spark, sf).select(*KEY, "lag", "n_valid", "corr")


@query
def lag_dot_product(spark, sf):
    return curve(spark, sf).select(*KEY, "lag", F.round("dot", 4).alias("dot"))


@query
def curve_interp(spark, sf):
    """Every seventh lag is taken out first, so that there are gaps to fill."""
    gappy = curve(spark, sf).withColumn("corr", F.when(F.col("lag") % 7 != 0, F.col("corr")))
    return align.interpolated(gappy).select(*KEY, "lag", "filled")


@query
def gauss_smooth(spark, sf):
    return smooth(spark, sf).select(*KEY, "lag", "sm")


@query
def peak_pick(spark, sf):
    return align.shapes(smooth(spark, sf)).select(*KEY, "optimal_shift_s", "peak_r", "peak_r_raw", "zero_lag_r", "n_valid")


@query
def second_peak(spark, sf):
    return align.shapes(smooth(spark, sf)).select(*KEY, "second_peak_r", "peak_margin")


@query
def mono_halfwidth(spark, sf):
    return align.shapes(smooth(spark, sf)).where("optimal_shift_s is not null").select(*KEY, "left_halfwidth_s", "right_halfwidth_s", "monotonic_halfwidth_s")


@query
def concavity_fraction(spark, sf):
    return align.shapes(smooth(spark, sf)).where("optimal_shift_s is not null").select(*KEY, "concavity_fraction")


@query
def shift_decision(spark, sf):
    return align.diagnose(frames.lag_pairs(spark, sf), "ref", TARGETS, LEAST).select(*KEY, "n_valid", "decision", "reason")


@query
def apply_shift(spark, sf):
    df = frames.lag_pairs(spark, sf)
    decisions = align.diagnose(df, "ref", TARGETS, LEAST)
    return align.apply_shift(df.select("flight_date", "rn", "tgt_a", "tgt_b"), decisions, {"a": ["tgt_a"], "b": ["tgt_b"]})


@query
def shift_diagnostics(spark, sf):
    return table(spark, sf)


@query
def shift_summary(spark, sf):
    return align.summary(table(spark, sf))


@query
def skip_reasons(spark, sf):
    return align.skip_reasons(table(spark, sf))


@query
def shift_pivot(spark, sf):
    return align.provenance(table(spark, sf), ("a", "b", "c"))


@query
def align_var_pick(spark, sf):
    groups = spark.createDataFrame([("optical", ["missing_var", "n_error", "n_click"]), ("micro", ["n_refund"]), ("nav", ["n_purchase", "n_view"])], "grp string, candidates array<string>")
    present = frames.sensor(spark, sf).select("flight_date", F.concat(F.lit("n_"), "event_type").alias("variable"))
    return align.pick_alignment(groups, present)


@query
def shift_table_groups(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    listed = part.select(
        F.col("p_partkey").alias("pos"), F.col("p_name").alias("variable"), F.col("p_brand").alias("shift_group"),
        F.concat(F.lit(" "), "p_type", F.lit(" |"), "p_name", F.lit("| ")).alias("alignment_variable"), F.when(F.col("p_size") % 3 == 0, "YES").otherwise("NO").alias("apply_time_shift"),
    )
    return align.shift_groups(listed).select("shift_group", F.array_join("candidates", ",").alias("candidates"), F.array_join("variables", ",").alias("variables"))
