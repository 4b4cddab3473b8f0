"""Queries of the variable catalogue; parts stand for variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators import catalog
from aerolith.plans.registry import query

TITLES = [("ECONOMY", "bulk"), ("SMALL", "bulk"), ("SMALL_red widget", "red"), ("SMALL_red", "never"), ("PROMO", None)]


def parts(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet")


def assigned(spark, sf) -> DataFrame:
    names = parts(spark, sf).select("p_partkey", F.concat_ws("_", "p_type", "p_name", F.col("p_size").cast("string")).alias("name"))
    return catalog.families(names, spark.createDataFrame(TITLES, "title string, family string"))


def channels(spark, sf, prefix: str) -> DataFrame:
    """Columns named after parts: wavelength by size, kind by type."""
    kind = F.when(F.col("p_type") == "SMALL", "_submicron").when(F.col("p_type") == "LARGE", "_total_amb").when(F.col("p_type") == "PROMO", "_total").when(F.col("p_type") == "MEDIUM", "_submicron_amb").otherwise("")
    wavelength = F.lit(400) + F.col("p_size") * 7
    return parts(spark, sf).select(F.col("p_partkey").alias("pos"), wavelength.alias("wavelength"), F.concat(F.lit(prefix), wavelength.cast("string"), kind, F.lit("_"), F.col("p_partkey").cast("string")).alias("column"))


@query
def channel_preference(spark, sf):
    return catalog.channel_preference(channels(spark, sf, "Sc"))


@query
def wavelength_match(spark, sf):
    best = catalog.channel_preference(channels(spark, sf, "Sc"))
    return catalog.wavelength_match(best, channels(spark, sf, "Ext"))


@query
def longest_prefix_family(spark, sf):
    return assigned(spark, sf)


@query
def family_members(spark, sf):
    return catalog.members(assigned(spark, sf)).select("family", F.size("names").alias("n"), F.get("names", F.lit(0)).alias("first_name"))


@query
def family_order(spark, sf):
    return catalog.family_order(assigned(spark, sf), ("red", "absent", "bulk"))


@query
def short_name(spark, sf):
    return assigned(spark, sf).select("p_partkey", catalog.short_name(F.col("name"), F.when(F.col("p_partkey") % 4 != 0, F.col("title")).otherwise("")).alias("short"))


@query
def guess_units(spark, sf):
    suffix = F.get(F.array(*[F.lit(x) for x in ("_ppm", "_ppb", "_cm3", "_percent", "_degC", "", "_ppt")]), (F.col("p_partkey") % 7).cast("int"))
    short = F.when(F.col("p_partkey") % 50 == 0, "Latitude").when(F.col("p_partkey") % 50 == 1, "GPS_altitude").otherwise(F.concat("p_name", suffix))
    return parts(spark, sf).select("p_partkey", short.alias("short"), catalog.guess_units(short).alias("units"))


@query
def measurement_basis(spark, sf):
    k = F.col("p_partkey")
    pick = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (k % len(xs)).cast("int"))
    standard, units, info = pick(("X_STP", "X_AMB", "Mass_STP_y", "", None)), pick(("ppmv", "unitless", "m-1", "degrees", "um", "", None)), pick(("At Standard_Temperature", "ambient temperature", "", "STP_used", "none"))
    name = F.when(k % 11 == 0, F.concat("p_name", F.lit("_stp"))).when(k % 13 == 0, F.lit("frac_x")).otherwise(F.col("p_name"))
    return parts(spark, sf).select("p_partkey", catalog.measurement_basis(standard, name, units, info).alias("basis"))


@query
def dedupe_names(spark, sf):
    title = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("XY "), "p_brand", F.lit(" LAS"))).otherwise(F.col("p_brand"))
    entries = parts(spark, sf).select("p_partkey", F.col("p_type").alias("family"), title.alias("title"), F.col("p_name").alias("short"))
    return catalog.unique_names(entries).select("p_partkey", "unique_name")


@query
def metadata_resolve(spark, sf):
    """Half of the parts are headers, by type; the other half look their names up."""
    p = parts(spark, sf)
    headers = p.where("p_size < 25").groupBy(F.col("p_type").alias("title"), F.col("p_name").alias("name")).agg(F.min("p_brand").alias("units"), F.min("p_size").cast("string").alias("standard"), F.lit("d").alias("description"))
    columns = p.where("p_size >= 25").select("p_partkey", F.col("p_type").alias("title"), F.col("p_name").alias("short"))
    return catalog.resolve(columns, headers).select("p_partkey", "units", "standard")


@query
def shift_group_lookup(spark, sf):
    p = parts(spark, sf)
    table = p.where("p_size < 4").groupBy(F.col("p_name").alias("variable")).agg(F.min_by("p_type", "p_partkey").alias("shift_group"))
    return catalog.shift_group(p.select("p_partkey", F.col("p_name").alias("name")), table)
