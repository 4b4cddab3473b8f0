"""Queries of row quality control and tumbling windows (one-hour windows of five valid rows: events are minutes apart)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.timekeys import epoch_seconds
from aerolith.operators import qc, report, retrieval, windows
from aerolith.plans import frames
from aerolith.plans.registry import query
from aerolith.sources import products

HOUR, LEAST = 3600, 5
SIGNALS, ABSORPTION, SCATTERING = ("sc450_dry", "sc550", "abs532"), ("abs470", "abs532", "abs660"), ("sc450", "sc550", "sc700")
KEY = ("flight_date", "event_id")


def cloud(df: DataFrame):
    return qc.cloud_raw(("n_cdp", "n_fcdp"), ("lwc_cdp", "lwc_fcdp"), df.columns)


def masked(spark, sf, spectrum: bool = False) -> DataFrame:
    df = frames.spectrum(spark, sf) if spectrum else frames.sensor(spark, sf)
    df = qc.derive_optical(df, SCATTERING, "rh", "gamma", wet_of="sc550").withColumn("cloud_raw", cloud(df))
    return qc.row_masks(qc.dilated(df, F.col("cloud_raw"), "_cloud"), F.col("_cloud"), "inlet", "sc450_dry", "ssa550").drop("_cloud")


def hourly(spark, sf, mode: str = "relative", limit: float = 0.3) -> DataFrame:
    w = windows.aggregate(masked(spark, sf), (*SIGNALS, "abs470", "ae"), HOUR)
    return w.withColumn("window_qc_flag", windows.quality_flag("ae", SIGNALS, LEAST, limit, mode))


@query
def gamma_adjust(spark, sf):
    df = frames.sensor(spark, sf)
    return df.select(*KEY, qc.gamma_adjust(F.col("sc550"), F.col("gamma"), F.col("rh"), F.lit(80.0)).alias("sc550_wet"))


@query
def derive_optical(spark, sf):
    df = qc.derive_optical(frames.sensor(spark, sf), SCATTERING, "rh", "gamma", wet_of="sc550")
    return df.select(*KEY, "sc450_dry", "sc550_dry", "sc700_dry", "sc550_wet")


@query
def cloud_mask_raw(spark, sf):
    df = frames.sensor(spark, sf)
    return df.select(*KEY, cloud(df).alias("cloud_raw"))


@query
def cloud_dilate(spark, sf):
    df = frames.sensor(spark, sf)
    return qc.dilated(df.select(*KEY, "ts", cloud(df).alias("cloud_raw")), F.col("cloud_raw"), "cloudy").select(*KEY, "cloudy")


@query
def cloud_dilate_global(spark, sf):
    df = frames.sensor(spark, sf)
    rows = df.select(*KEY, "ts", cloud(df).alias("cloud_raw"))
    return qc.dilate_global(rows, "cloud_raw", "cloudy").select(*KEY, "cloudy")


@query
def row_qc(spark, sf):
    return masked(spark, sf).select(*KEY, *qc.ROW_BITS, "valid")


@query
def row_qc_flag(spark, sf):
    return masked(spark, sf).select(*KEY, qc.row_flag().alias("row_qc_flag"))


@query
def row_qc_totals(spark, sf):
    return qc.row_totals(masked(spark, sf))


@query
def angstrom(spark, sf):
    return frames.sensor(spark, sf).select(*KEY, qc.angstrom(F.col("abs532"), 532, 550).alias("abs550"))


@query
def ssa_methods(spark, sf):
    sc, ab = F.col("sc550"), qc.angstrom(F.col("abs532"), 532, 550)
    one, two = qc.ssa_two_ways(sc, qc.angstrom(F.col("sc450") + F.col("abs470"), 532, 550), ab)
    return frames.sensor(spark, sf).select(*KEY, one.alias("ssa_ext"), two.alias("ssa_abs"))


@query
def window_reason_counts(spark, sf):
    w = windows.aggregate(masked(spark, sf), (), HOUR)
    return w.select("window_start", "n_total", *[f"n_{r}" for r in windows.REASONS])


@query
def window_valid_stats(spark, sf):
    w = windows.aggregate(masked(spark, sf), ("sc450_dry", "abs470", "ae"), HOUR)
    return w.select("window_start", *[f"{c}_{s}" for c in ("sc450_dry", "abs470", "ae") for s in ("mean", "std")])


@query
def window_psd_mean(spark, sf):
    w = windows.spectrum_means(masked(spark, sf, spectrum=True), "psd", frames.N_BINS, HOUR, LEAST)
    return w.select("window_start", F.posexplode("psd").alias("bin", "mean"))


@query
def window_qc_flag(spark, sf):
    """Flagship: row quality, one aggregation per window, quality bits."""
    return hourly(spark, sf).select("window_start", "n_total", *[f"n_{r}" for r in windows.REASONS], "ae_mean", "ae_std", "window_qc_flag")


@query
def window_qc_flag_abs(spark, sf):
    return hourly(spark, sf, "absolute", 0.45).select("window_start", "window_qc_flag")


@query
def window_bounds(spark, sf):
    return windows.bounds(windows.aggregate(masked(spark, sf), (), HOUR), HOUR).select("window_start", "time_start", "time_end", "time_centre")


@query
def max_windows(spark, sf):
    return windows.first_passing(hourly(spark, sf).select("window_start", "window_qc_flag"), 100)


@query
def qc_funnel(spark, sf):
    hour = F.floor(F.col("window_start") / HOUR)
    results = hourly(spark, sf).withColumns({"attempt_flag_cri": F.when(hour % 3 == 0, 2).when(hour % 3 == 1, 1), "attempt_flag_kappa": F.when(hour % 2 == 0, 2)})
    return windows.funnel(results)


@query
def native_step(spark, sf):
    return windows.native_step(frames.sensor(spark, sf))


@query
def window_raw_stats(spark, sf):
    return windows.raw_statistics(frames.sensor(spark, sf), ("sc450", "abs470"), HOUR)


@query
def vector_wind(spark, sf):
    df = frames.sensor(spark, sf).withColumn("direction", (F.col("event_id") * 37 % 360).cast("double"))
    return windows.vector_wind(df, "value", "direction", HOUR)


@query
def qc_composition(spark, sf):
    w = windows.aggregate(masked(spark, sf), (), HOUR)
    return report.composition(w, [f"n_{r}" for r in windows.REASONS])


@query
def retrieval_inputs(spark, sf):
    df = masked(spark, sf, spectrum=True)
    w = hourly(spark, sf).join(windows.spectrum_means(df, "psd", frames.N_BINS, HOUR, LEAST), "window_start")
    made = retrieval.inputs(w, "psd", ("sc450_dry_mean", "sc550_mean"), ("abs470_mean", "abs532_mean"), [0.01 * 2**i for i in range(frames.N_BINS)])
    scaled = lambda c, i: (F.col(c)[i] * 1e6).alias(f"{c}_{i}")
    return made.select("window_start", *[scaled(c, i) for c in ("sca_per_m", "abs_per_m") for i in (0, 1)], F.col("radii_um")[3].alias("radius_3"), F.col("spectrum")[2].alias("bin_2"))


@query
def retrieval_failures(spark, sf):
    w = windows.spectrum_means(masked(spark, sf, spectrum=True), "psd", frames.N_BINS, HOUR, LEAST + 4)
    return retrieval.failures(w, "psd").select("window_start", "attempt_flag_cri", "retrieval_error")


def attempts(spark, sf) -> DataFrame:
    hour = F.floor(F.col("window_start") / HOUR)
    good = hourly(spark, sf).where("window_qc_flag = 0 and n_valid % 5 <> 0")
    return good.select("window_start", F.when(hour % 3 == 0, 1).otherwise(2).alias("attempt_flag_cri"), (F.col("ae_mean") / 2).alias("rri"))


@query
def assemble(spark, sf):
    return retrieval.assemble(hourly(spark, sf).select("window_start", "window_qc_flag"), attempts(spark, sf))


@query
def retrieval_qc_flag(spark, sf):
    joined = retrieval.assemble(hourly(spark, sf).select("window_start", "window_qc_flag"), attempts(spark, sf))
    return joined.select("window_start", retrieval.quality_flag(F.col("window_qc_flag"), F.col("attempt_flag_cri")).alias("retrieval_qc_flag"))


@query
def retrieval_select_si(spark, sf):
    """Selected, renamed and scaled channels, shown in per Gm so that rounding keeps their digits."""
    w = hourly(spark, sf)
    return products.select_scaled(w, {f"sca_{n}": (c, retrieval.PER_MM * 1e9) for n, c in (("450", "sc450_dry_mean"), ("550", "sc550_mean"))}, ["window_start"])


@query
def window_broadcast(spark, sf):
    from aerolith.functions.timekeys import bucket
    from aerolith.operators.flights import broadcast_windows

    rows = frames.sensor(spark, sf).select(*KEY, bucket("ts", HOUR).alias("window_start"))
    good = hourly(spark, sf).where("window_qc_flag = 0")
    return broadcast_windows(rows, good, "window_start", ["ae_mean"])


@query
def hist30(spark, sf):
    return report.histogram(frames.events(spark, sf), "value")


@query
def closure_pairs(spark, sf):
    df = qc.derive_optical(frames.sensor(spark, sf), SCATTERING, "rh", "gamma", wet_of="sc550")
    return report.closure_pairs(df, "sc450", "abs470", KEY)


@query
def psd_quartiles(spark, sf):
    return report.spectrum_quartiles(frames.spectrum(spark, sf), "psd")


@query
def moving_mean(spark, sf):
    return report.moving_mean(frames.sensor(spark, sf), "sc450", 10, "smooth").select(*KEY, "smooth")


@query
def best_window(spark, sf):
    df = frames.sensor(spark, sf).withColumn("at", epoch_seconds("ts"))
    return report.best_window(df, "sc450", ("abs470", "ssa550"), 900).select("flight_date", "priority", "at", "sc450")


@query
def derived_stats(spark, sf):
    derived = {"ratio": qc.positive_ratio(F.col("sc450"), F.col("abs470")), "total": F.col("sc550") + F.col("abs532")}
    return report.statistics(frames.sensor(spark, sf), derived, ("flight_date",))


@query
def date_sufficiency(spark, sf):
    return report.sufficient_dates(frames.sensor(spark, sf), ("sc450", "abs470"), 310)


@query
def date_subset(spark, sf):
    days = F.to_date(F.lit("2024-01-05")), F.to_date(F.lit("2024-01-11"))
    return frames.sensor(spark, sf).where(F.col("flight_date").isin(*days)).select(*KEY, "sc450")
