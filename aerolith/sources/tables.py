"""Small input tables: bin tables, shift tables, diagnostics and family maps; and selection of rows by file name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.nulls import nan_to_null

BINS = "dpl double, dpg double, dpu double"
SHIFTS = "variable string, shift_group string, alignment_variable string, apply_time_shift string"
DIAGNOSTICS = (
    "date string, shift_group string, alignment_variable string, n_valid long, optimal_shift_s double, peak_r double, peak_r_raw double, zero_lag_r double, peak_margin double, "
    "second_peak_r double, monotonic_halfwidth_s double, left_halfwidth_s double, right_halfwidth_s double, concavity_fraction double, decision string, reason string, n_vars_shifted long"
)


def merged(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """A merged table with NaN as null; dates prune the partitions that are read."""
    df = spark.read.parquet(path)
    return nan_to_null(df.where(F.col("flight_date").isin(*dates)) if dates else df)


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    wanted = [f.split()[0] for f in schema.split(", ")]
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    kinds = dict(f.split() for f in schema.split(", "))
    return raw.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in wanted])


def bin_table(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, BINS).orderBy("dpg")


def shift_table(spark: SparkSession, path: str) -> DataFrame:
    """With pos, the order of the rows in the file."""
    return _csv(spark, path, SHIFTS).withColumn("pos", F.monotonically_increasing_id())


def diagnostics(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, DIAGNOSTICS)


def family_map(spark: SparkSession, path: str) -> DataFrame:
    """(title, family) from a JSON file with the map title_to_family."""
    schema = "title_to_family map<string,string>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("title_to_family").alias("title", "family"))


def by_name(df: DataFrame, column: str, pattern: str, groups: dict[str, int]) -> DataFrame:
    """Rows whose column fits the pattern, with the pattern's groups as columns."""
    return df.where(F.col(column).rlike(pattern)).withColumns({name: F.regexp_extract(column, pattern, i) for name, i in groups.items()})
