"""Self-describing instrument text files (FFI-1001): header catalogue, data rows, envelopes and file selection.

Files are read whole, one row each, and taken apart by column expressions; a file that can't be read
so goes to `bad_files` and doesn't stop the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.operators.catalog import clean_title

# Fixed values of the format: file names, header positions, and the words and units that bins are given by.
#: File names: instrument, platform, date, revision, leg.
NAME = r"^([A-Za-z0-9\-]+)_HU25_(\d{8})_R\d+(?:_L(\d))?\.ict$"
#: Lines before the variables' definitions, and where the count, scales, missing values and title stand (from 1).
TITLE, COUNT, MISSING, DEFINITIONS = 4, 10, 12, 13


def read_files(spark: SparkSession, path: str, glob: str = "*.ict") -> DataFrame:
    """file, content of every file."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return texts.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))


def select_files(files: DataFrame, name: str = NAME, instruments: Sequence[str] = (), dates: tuple[str, str] | None = None, year: int | None = None) -> DataFrame:
    """Files whose name fits, with instr and flight_date, of the given instruments, dates (both ends included) and year."""
    out = files.where(F.col("file").rlike(name)).withColumns({"instr": F.regexp_extract("file", name, 1), "flight_date": F.try_to_date(F.regexp_extract("file", name, 2), "yyyyMMdd")})
    if instruments:
        out = out.where(F.col("instr").isin(*instruments))
    if dates:
        out = out.where(F.col("flight_date").between(*(F.to_date(F.lit(d)) for d in dates)))
    return out.where(F.year("flight_date") == year) if year else out


def parsed(files: DataFrame) -> DataFrame:
    """Files with lines, n_header, title, n_vars; ok: whether the header could be read."""
    lines = F.split("content", "\r?\n")
    number = lambda line: F.split(F.get(F.col("lines"), F.lit(line - 1)), ",")[0].try_cast("int")
    out = files.withColumn("lines", lines).withColumns({"n_header": number(1), "n_vars": number(COUNT), "title": F.trim(F.get(F.col("lines"), F.lit(TITLE - 1)))})
    ok = F.col("n_header").isNotNull() & F.col("n_vars").isNotNull() & (F.size("lines") >= F.col("n_header")) & (F.col("n_header") >= DEFINITIONS - 1 + F.col("n_vars"))
    return out.withColumn("ok", F.coalesce(ok, F.lit(False)))


def bad_files(files: DataFrame) -> DataFrame:
    """Names of the files whose header can't be read."""
    return parsed(files).where("not ok").select("file")


def header_variables(files: DataFrame) -> DataFrame:
    """One row per declared variable: file, title, pos, name, units, standard, description."""
    good = parsed(files).where("ok")
    listed = good.select("file", "title", F.posexplode(F.slice("lines", DEFINITIONS, F.col("n_vars"))).alias("pos", "line"))
    parts = F.split("line", ",", 4)
    field = lambda i: F.trim(F.coalesce(F.get(parts, F.lit(i)), F.lit("")))
    return listed.select("file", "title", "pos", *[field(i).alias(n) for i, n in enumerate(("name", "units", "standard", "description"))])


def header_comments(files: DataFrame, key: str = r"^([A-Z_]{4,})\s*:") -> DataFrame:
    """file, key, text of the keyed comments; lines without a key continue the one before."""
    good = parsed(files).where("ok")
    block = F.slice("lines", F.lit(DEFINITIONS) + F.col("n_vars"), F.greatest(F.col("n_header") - (DEFINITIONS - 1) - F.col("n_vars"), F.lit(0)))
    lines = good.select("file", F.posexplode(block).alias("pos", "line"))
    found = F.when(F.col("line").rlike(key), F.regexp_extract("line", key, 1))
    along = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    carried = lines.withColumn("found", found).withColumn("key", F.last("found", True).over(along)).where("key is not null")
    own = F.trim(F.when(F.col("found").isNotNull(), F.regexp_replace("line", key, "")).otherwise(F.col("line")))
    texts = F.array_sort(F.collect_list(F.struct("pos", own.alias("text"))))
    return carried.groupBy("file", "key").agg(F.array_join(F.transform(texts, lambda x: x["text"]), "\n").alias("text"))


def scan(files: DataFrame, prefix_title: bool = False) -> DataFrame:
    """Data rows in long form: file, instr, flight_date, pos, seconds (after midnight of the file's date), variable, value.
    Values equal to the variable's missing value are null."""
    good = parsed(select_files(files)).where("ok")
    names = F.transform(F.slice("lines", DEFINITIONS, F.col("n_vars")), lambda x: F.trim(F.split(x, ",")[0]))
    if prefix_title:
        names = F.transform(names, lambda x: F.concat_ws("_", clean_title(F.col("title")), x))
    missing = F.transform(F.split(F.get(F.col("lines"), F.lit(MISSING - 1)), ","), lambda x: F.trim(x).try_cast("double"))
    data = F.filter(F.slice("lines", F.col("n_header") + 1, F.greatest(F.size("lines") - F.col("n_header"), F.lit(0))), lambda x: F.trim(x) != "")
    rows = good.select("file", "instr", "flight_date", names.alias("names"), missing.alias("missing"), F.posexplode(data).alias("pos", "line"))
    fields = F.transform(F.split("line", ","), lambda x: F.trim(x).try_cast("double"))
    cut = rows.withColumn("fields", fields).select("file", "instr", "flight_date", "pos", F.get("fields", F.lit(0)).alias("seconds"), "missing", F.posexplode("names").alias("i", "variable"), "fields")
    value = F.get("fields", F.col("i") + 1)
    return cut.select("file", "instr", "flight_date", "pos", "seconds", "variable", F.when(~F.equal_null(value, F.get("missing", F.col("i"))), value).alias("value"))


def schema_union(variables: DataFrame) -> DataFrame:
    """Per instrument the variables of its first and last file (by date); the first file's definition wins. variables:
    header_variables() with instr and flight_date."""
    ends = variables.groupBy("instr").agg(F.min("flight_date").alias("first"), F.max("flight_date").alias("last"))
    kept = variables.join(ends, "instr").where((F.col("flight_date") == F.col("first")) | (F.col("flight_date") == F.col("last")))
    definition = F.struct("units", "standard", "description", "pos")
    best = kept.groupBy("instr", "name").agg(F.min_by(definition, F.struct("flight_date", "file")).alias("d"))
    return best.select("instr", "name", "d.units", "d.standard", "d.description")


def marker_envelopes(lines: DataFrame) -> DataFrame:
    """file, leg, start_s, end_s: times of the first and last data line (by position). lines: file, pos, at."""
    leg = F.regexp_extract("file", r"_L(\d+)\.ict$", 1)
    return lines.groupBy("file").agg(F.min_by("at", "pos").alias("start_s"), F.max_by("at", "pos").alias("end_s")).withColumn("leg", F.when(leg != "", leg.cast("long")))


def bins_from_descriptions(variables: DataFrame) -> DataFrame:
    """name and centre (um) of variables that give `bin_center_X um` (a fixed pattern)."""
    pattern = r"(?i)bin_center_([0-9.]+)\s*um"
    centre = F.coalesce(*[F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")) for c in ("description", "standard")])
    return variables.select("file", "pos", "name", centre.cast("double").alias("centre")).where("centre is not null")


def _numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9.]+"), F.lit(0)), lambda x: x.cast("double"))


def bins_from_edges(comments: Column) -> Column:
    """Array of (centre, lower, upper) in um from `Bin Lower Edges (in um) = [...]` and `Bin Upper Edges ...` (fixed patterns)."""
    edge = lambda which: _numbers(F.regexp_extract(comments, rf"(?i)Bin\s+{which}\s+Edges?\s*\(in\s*um\)\s*=\s*\[([^\]]*)\]", 1))
    return F.zip_with(edge("Lower"), edge("Upper"), lambda a, b: F.struct(F.sqrt(a * b).alias("centre"), a.alias("lower"), b.alias("upper")))


def bins_from_bounds(comments: Column) -> Column:
    """The same from lines of bounds and mid points in nm (fixed patterns)."""
    line = lambda which: _numbers(F.regexp_extract(comments, rf"(?i){which}\s*:\s*([0-9.,\s]+)", 1))
    both = F.arrays_zip(line("Mid points").alias("m"), line("Lower Bounds").alias("a"), line("Upper Bounds").alias("b"))
    return F.transform(both, lambda x: F.struct((x["m"] / 1000).alias("centre"), (x["a"] / 1000).alias("lower"), (x["b"] / 1000).alias("upper")))
