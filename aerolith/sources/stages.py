"""Stage tables whose dates are replaced at once: runs write beside each other, and a manifest says which run a date is read from.

A run's rows lie under data/<run>; versions/<number> is a small table (date, run) that is written aside and renamed into place.
A reader takes the latest version when it asks, so it never sees half a rerun, and what it holds stays as it was, since
runs aren't overwritten. Two writers that start from one version can't both commit: the second one's rename fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Stage:
    """A stage table under path, by date."""

    def __init__(self, spark: SparkSession, path: str, date: str = "flight_date"):
        self.spark, self.path, self.date = spark, path.rstrip("/"), date

    def _place(self, name: str):
        """The file system and the path of something under the table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """The latest version's number; 0 before the first."""
        fs, path = self._place("versions")
        return max((int(f.getPath().getName()) for f in fs.listStatus(path)), default=0) if fs.exists(path) else 0

    def runs(self, version: int | None = None) -> dict[str, str]:
        """date: run, of a version (the latest one without)."""
        number = self.version() if version is None else version
        return {r["date"]: r["run"] for r in self.spark.read.parquet(f"{self.path}/versions/{number:08d}").collect()} if number else {}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest one without). Needs one with a row."""
        runs = self.runs(version)
        if not runs:
            raise ValueError(f"{self.path} holds no rows")
        parts = [f"{self.path}/data/{run}/_date={d}" for d, run in runs.items()]
        return self.spark.read.parquet(*parts)

    def replace(self, rows: DataFrame, dates: Sequence[str]) -> int:
        """Commit rows as all there is of these dates: those without a row go. Returns the version's number."""
        before, run = self.version(), uuid.uuid4().hex
        own = rows.where(F.col(self.date).cast("string").isin(list(dates))).withColumn("_date", F.col(self.date).cast("string"))
        own.write.partitionBy("_date").parquet(f"{self.path}/data/{run}")
        fs, path = self._place(f"data/{run}")
        held = [f.getPath().getName().partition("=")[2] for f in fs.listStatus(path) if f.getPath().getName().startswith("_date=")]
        runs = {d: r for d, r in (self.runs(before) if before else {}).items() if d not in set(dates)} | dict.fromkeys(held, run)
        aside = f"pending/{run}"
        kind = T.StructType([T.StructField("date", T.StringType()), T.StructField("run", T.StringType())])
        self.spark.createDataFrame(sorted(runs.items()), kind).coalesce(1).write.parquet(f"{self.path}/{aside}")
        _, source = self._place(aside)
        _, target = self._place(f"versions/{before + 1:08d}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"version {before + 1} of {self.path} was committed by another writer")
        return before + 1


def near(dates: Sequence[str], days: int) -> list[str]:
    """The dates and those up to so many days before and after."""
    return sorted({str(Date.fromisoformat(d) + timedelta(k)) for d in dates for k in range(-days, days + 1)})


def rerun(stage: Stage, source: DataFrame, dates: Sequence[str], compute: Callable[[DataFrame], DataFrame], halo_days: int = 1) -> int:
    """Make these dates again, with the neighbours whose rows depend on theirs, in one commit. compute looks at most halo_days
    days to either side, so it gets that much more of the source than it makes."""
    affected = near(dates, halo_days)
    seen = source.where(F.col(stage.date).cast("string").isin(near(affected, halo_days)))
    return stage.replace(compute(seen), affected)
