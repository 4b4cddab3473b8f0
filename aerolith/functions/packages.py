"""The library's code on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their tasks can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_aerolith_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}_code", "zip", package.parent, package.name)
    sc.addPyFile(archive)
    sc._aerolith_shipped = True
