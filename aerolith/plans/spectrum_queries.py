"""Queries of size spectra on the twelve-bin frame (diameters 10 * 2^i nm)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import qc, retrieval, spectra
from aerolith.plans import frames
from aerolith.plans.registry import query

KEY = ("flight_date", "event_id")
DIAMETERS = [10.0 * 2**i for i in range(frames.N_BINS)]
RADII = [d / 2 for d in DIAMETERS]


@query
def bin_grid(spark, sf):
    """Six bins of each instrument in um, cut at 1 um and from 20 nm on."""
    table = [(d / 2**0.5 / 1000, d / 1000, d * 2**0.5 / 1000) for d in DIAMETERS]
    kept = spectra.combined_grid(table[:6], table[6:], largest=1.0, smallest=0.02)
    return frames.spectrum(spark, sf).select(*KEY, F.size(spectra.take(F.col("psd"), kept)).alias("n_bins"), spectra.sum_if_any(spectra.take(F.col("psd"), kept)).alias("total"))


@query
def edges_from_centers(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    centres = part.groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_set("p_size")), lambda x: x.cast("double")).alias("centres"))
    made = centres.select("p_brand", "centres", F.posexplode(spectra.edges(F.col("centres"))).alias("pos", "e"))
    return made.select("p_brand", "pos", F.get("centres", F.col("pos")).alias("centre"), "e.lower", "e.upper")


@query
def bin_name_parse(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    size, tag = F.col("p_size").cast("string"), F.replace("p_brand", F.lit("#"), F.lit(""))
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("X_"), tag, F.lit("_Bin"), F.lpad(size, 3, "0"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("dNdlogD_"), F.lpad(size, 3, "0"), F.lit("_"), tag)).otherwise(F.col("p_name"))
    tag_of, number = spectra.bin_name(F.col("name"))
    return part.select("p_partkey", name.alias("name")).select("p_partkey", "name", tag_of.alias("tag"), number.alias("number"))


@query
def bin_compact(spark, sf):
    """Spectra spread to one row per bin and compacted again, by instrument (six bins each)."""
    long = frames.spectrum(spark, sf).select(*KEY, F.posexplode("psd").alias("pos", "value"))
    named = long.select(*KEY, F.when(F.col("pos") < 6, "smps").otherwise("las").alias("tag"), (F.col("pos") % 6).alias("number"), "value")
    made = spectra.compact(named, KEY)
    return made.select(*KEY, "tag", F.size("bins").alias("n_bins"), F.get("bins", F.lit(2)).alias("bin_2"), spectra.sum_if_any(F.col("bins")).alias("total"))


@query
def sigma_geo(spark, sf):
    kept = spectra.without_overlap(RADII[:7], RADII[5:], 500.0)
    at = [i if instrument == "smps" else i + 5 for instrument, i, _ in kept]
    return frames.spectrum(spark, sf).select(*KEY, spectra.cross_section(spectra.take(F.col("psd"), at), [r for _, _, r in kept]).alias("sigma_geo"))


@query
def dndlogdp_to_n(spark, sf):
    numbers = spectra.weighted(F.col("psd"), spectra.log_widths(DIAMETERS))
    return frames.spectrum(spark, sf).select(*KEY, F.get(numbers, F.lit(0)).alias("n_0"), F.get(numbers, F.lit(5)).alias("n_5"), spectra.sum_if_any(numbers).alias("total"))


@query
def scattering_efficiency(spark, sf):
    sigma = spectra.cross_section(F.col("psd"), RADII)
    return frames.spectrum(spark, sf).select(*KEY, qc.positive_ratio(F.col("sc550"), sigma).alias("efficiency"))


@query
def bin_pattern(spark, sf):
    return frames.spectrum(spark, sf).select(*KEY, F.concat_ws(",", F.transform(spectra.pattern(F.col("psd")), lambda i: i.cast("string"))).alias("pattern"))


@query
def bin_pattern_counts(spark, sf):
    found = spectra.common_patterns(frames.spectrum(spark, sf), "psd")
    return found.select(F.concat_ws(",", F.transform("pattern", lambda i: i.cast("string"))).alias("pattern"), "n")


@query
def lut_grid_search(spark, sf):
    """Windows are embeddings (their first two components stand for measured channels, which are missing or zero in some);
    kernels of twenty candidates and two channels are the means of all embeddings that fall to them by id."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    windows = vectors.select(F.col("vec_id").alias("window_start"), F.col("v").alias("psd"), F.when(F.col("vec_id") % 3 != 0, F.col("v")[0] + 2).alias("m0"), F.when(F.col("vec_id") % 5 == 0, 0.0).otherwise(F.col("v")[1] + 2).alias("m1"))
    parts = vectors.select((F.col("vec_id") % 20).alias("candidate"), (F.floor(F.col("vec_id") / 20) % 2).cast("int").alias("channel"), F.posexplode("v").alias("pos", "x"))
    means = parts.groupBy("candidate", "channel", "pos").agg((F.avg("x") * 10).alias("x"))
    kernels = means.groupBy("candidate", "channel").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("kernel"))
    return retrieval.grid_search(windows, ("m0", "m1"), "psd", kernels, 0.5)
