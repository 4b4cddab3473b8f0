"""Products as partitioned Parquet tables, stage tables that are replaced by date, and the provenance row."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Retrieval columns to be renamed: state, origin, quantity, wavelength, unit.
COEFFICIENT = re.compile(r"^(dry|wet)_(cal|meas)_(sca_coef|abs_coef|ext_coef|SSA)_(\d+)_(m-1|unitless)$")


def narrow(df: DataFrame) -> DataFrame:
    """Doubles as floats, for storage."""
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema if isinstance(f.dataType, T.DoubleType)} or {"_": F.lit(None)}).drop("_")


def described(df: DataFrame, facts: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Columns with units, names and the like in their metadata."""
    return df.select(*[F.col(c).alias(c, metadata=dict(facts[c])) if c in facts else F.col(c) for c in df.columns])


def write_dates(df: DataFrame, path: str, date: str = "flight_date") -> None:
    """Write a stage table by date; dates that df holds replace those in the table, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def write_observations(df: DataFrame, path: str, members: Mapping[str, Sequence[str]], key: Sequence[str], facts: Mapping[str, Mapping[str, str]] | None = None, date: str = "flight_date") -> None:
    """One dataset per family: key, its columns and the row flag, narrowed and described."""
    for family, columns in members.items():
        write_dates(described(narrow(df.select(date, *key, *columns)), facts or {}), f"{path}/{family}", date)


def write_windows(windows: DataFrame, bins: DataFrame, path: str) -> None:
    windows.write.mode("overwrite").parquet(f"{path}/windows")
    bins.write.mode("overwrite").parquet(f"{path}/psd_bin")


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """df as the table `name` under path, in buckets of the keys with one sorted file each. Tables in equally many buckets of the
    keys that they are joined or grouped by meet without a shuffle."""
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def rename_coefficients(df: DataFrame) -> DataFrame:
    """Calculated coefficients as state_calculated_quantity_wavelength; measured ones go."""
    found = {c: m for c in df.columns if (m := COEFFICIENT.match(c))}
    kept = df.drop(*[c for c, m in found.items() if m[2] == "meas"])
    return kept.withColumnsRenamed({c: f"{m[1]}_calculated_{m[3].lower()}_{m[4]}nm" for c, m in found.items() if m[2] == "cal"})


def select_scaled(df: DataFrame, columns: Mapping[str, tuple[str, float]], key: Sequence[str]) -> DataFrame:
    """Renamed and scaled columns: new name to (column, factor)."""
    return df.select(*key, *[(F.col(c) * factor).alias(name) for name, (c, factor) in columns.items()])


def write_results(results: DataFrame, config: Mapping, path: str) -> None:
    """Results and the configuration that made them."""
    results.write.mode("overwrite").parquet(f"{path}/results")
    one = results.sparkSession.createDataFrame([(json.dumps(dict(config), sort_keys=True),)], "config_json string")
    one.write.mode("overwrite").parquet(f"{path}/config")


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    return spark.read.parquet(f"{path}/results"), json.loads(spark.read.parquet(f"{path}/config").first()["config_json"])


def provenance_row(dropped: DataFrame, title: str, window_s: int, config: Mapping, source: str, instruments: str, version: str = "") -> DataFrame:
    """One row: title, window length, configuration, rows dropped, segmentation source, instruments, version."""
    facts = {"title": title, "config_json": json.dumps(dict(config), sort_keys=True), "segmentation_source": source, "instruments": instruments, "version": version}
    return dropped.select(*[F.lit(v).alias(k) for k, v in facts.items()], F.lit(window_s).alias("window_s"), "n_dropped", "percent_dropped")
