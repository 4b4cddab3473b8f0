"""Text files read by lines and splits: a file of any size is many tasks, and rows that can't be read are set aside.

Spark cuts a large file into splits, and a task hands its lines on in order. So a line's number is its place in its split and
the lines of the splits before: both follow from the least and greatest row number of each split, one small aggregation. A
file's header (its first lines) is gathered into one row of the frame that `icartt` takes files apart in; data lines meet it by file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.functions.storage import shared_path, written
from aerolith.operators.catalog import clean_title
from aerolith.sources import icartt

#: A first line that asks for more header lines than this isn't a header.
MAX_HEADER = 10_000
#: Bytes of headers up to which data lines meet them without a shuffle.
BROADCAST_BYTES = 32 << 20
#: Why a data line is set aside.
NO_TIME, TOO_FEW, TOO_MANY, NO_NUMBER = "time can't be read", "too few fields", "too many fields", "number can't be read"


def read_lines(spark: SparkSession, path: str, glob: str = "*", name: Column | None = None) -> DataFrame:
    """file, line (its number, from 0), value of every line of the files. name: the file's name, from `_metadata`."""
    raw = spark.read.text(path, pathGlobFilter=glob, recursiveFileLookup=True)
    place = (F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    lines = raw.select("value", (F.col("_metadata.file_name") if name is None else name).alias("file"), *place)
    splits = lines.groupBy("_path", "_start").agg(F.min("_id").alias("_first"), (F.max("_id") - F.min("_id") + 1).alias("_n"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = written(splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    met = lines.join(splits, ["_path", "_start"])
    return met.select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line"), F.regexp_replace("value", "\r$", "").alias("value"))


def headers(lines: DataFrame) -> DataFrame:
    """file, content of each file's header; of files whose first line doesn't say how long it is, that line. Written once."""
    asked = F.split("value", ",")[0].try_cast("int")
    firsts = lines.where("line = 0").select("file", F.when(asked.between(1, MAX_HEADER), asked).otherwise(1).alias("_n"))
    own = lines.where(F.col("line") < MAX_HEADER).join(firsts, "file").where(F.col("line") < F.col("_n"))
    listed = F.array_sort(F.collect_list(F.struct("line", "value")))
    return written(own.groupBy("file").agg(F.array_join(F.transform(listed, lambda x: x["value"]), "\n").alias("content")))


@dataclass(frozen=True)
class Scan:
    """values: file, instr, flight_date, pos, seconds, variable, value, as icartt.scan() gives them; quarantine: file, instr,
    flight_date, pos, value (the line), reason; counts: n_lines, n_bad and those of each reason."""

    values: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def scan(lines: DataFrame, heads: DataFrame, prefix_title: bool = False) -> Scan:
    """The data lines of files with a readable header, in one pass: lines whose time or numbers can't be read, or that have
    too few or too many fields, go to the quarantine with the first reason that holds, and count there. Empty fields and the
    variable's missing value are null; blank lines are passed by. pos counts the lines after the header, from 0."""
    good = icartt.parsed(icartt.select_files(heads)).where("ok")
    names = F.transform(F.slice("lines", icartt.DEFINITIONS, F.col("n_vars")), lambda x: F.trim(F.split(x, ",")[0]))
    if prefix_title:
        names = F.transform(names, lambda x: F.concat_ws("_", clean_title(F.col("title")), x))
    missing = F.transform(F.split(F.get(F.col("lines"), F.lit(icartt.MISSING - 1)), ","), lambda x: F.trim(x).try_cast("double"))
    facts = written(good.select("file", "instr", "flight_date", "n_header", "n_vars", names.alias("names"), missing.alias("missing")))
    size = heads.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    met = lines.where(F.trim("value") != "").join(F.broadcast(facts) if size <= BROADCAST_BYTES else facts, "file").where(F.col("line") >= F.col("n_header"))
    texts = F.transform(F.split("value", ","), lambda x: F.trim(x))
    fields = met.withColumn("texts", texts).withColumn("fields", F.transform("texts", lambda x: x.try_cast("double")))
    unread = F.exists(F.sequence(F.lit(1), F.size("texts") - 1), lambda i: F.get("fields", i).isNull() & (F.get("texts", i) != ""))
    count = F.size("texts") - 1
    reason = F.when(F.get("fields", F.lit(0)).isNull(), NO_TIME).when(count < F.col("n_vars"), TOO_FEW).when(count > F.col("n_vars"), TOO_MANY).when(unread, NO_NUMBER)
    told = fields.select("file", "instr", "flight_date", (F.col("line") - F.col("n_header")).alias("pos"), "value", "fields", F.coalesce(reason, F.lit("")).alias("reason"))
    seen = Observation()
    each = [F.count_if(F.col("reason") == r).alias(r) for r in (NO_TIME, TOO_FEW, TOO_MANY, NO_NUMBER)]
    path = shared_path(lines.sparkSession)
    told.withColumn("bad", F.col("reason") != "").observe(seen, F.count("*").alias("n_lines"), F.count_if(F.col("reason") != "").alias("n_bad"), *each).write.partitionBy("bad").parquet(path)
    schema = told.schema.add("bad", "boolean")
    read = lines.sparkSession.read.schema(schema).parquet(path)
    rows = read.where("not bad").select("file", "instr", "flight_date", "pos", "fields").join(F.broadcast(facts) if size <= BROADCAST_BYTES else facts, ["file", "instr", "flight_date"])
    cut = rows.select("file", "instr", "flight_date", "pos", F.get("fields", F.lit(0)).alias("seconds"), "missing", F.posexplode("names").alias("i", "variable"), "fields")
    value = F.get("fields", F.col("i") + 1)
    values = cut.select("file", "instr", "flight_date", "pos", "seconds", "variable", F.when(~F.equal_null(value, F.get("missing", F.col("i"))), value).alias("value"))
    return Scan(values, read.where("bad").select("file", "instr", "flight_date", "pos", "value", "reason"), seen.get)


def failures(heads: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per date: files, those whose header can't be read, data lines set aside, and failed: whether no file of the date could be
    read. Files whose name doesn't fit aren't counted."""
    files = icartt.parsed(icartt.select_files(heads)).groupBy("flight_date").agg(F.count("*").alias("n_files"), F.count_if(~F.col("ok")).alias("n_bad_files"))
    bad = quarantine.groupBy("flight_date").agg(F.count("*").alias("n_bad_rows"))
    both = files.join(bad, "flight_date", "left").withColumn("n_bad_rows", F.coalesce("n_bad_rows", F.lit(0)))
    return both.withColumn("failed", F.col("n_files") == F.col("n_bad_files"))
