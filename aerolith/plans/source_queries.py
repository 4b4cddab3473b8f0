"""Queries of scans, file selection and merging; events of one type stand for one instrument."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.storage import shared_path
from aerolith.functions.timekeys import epoch_seconds
from aerolith.operators import catalog, merge, report
from aerolith.plans import frames
from aerolith.plans.registry import query
from aerolith.sources import icartt, lines, tables

HEADER = ("15, 1001", "PI", "organisation", "{title}", "mission", "1, 1", "2024, 1, 1", "1", "seconds", "2", "1, 1", "-9999, -8888", "value, counts, std_STP, the value, in counts", "user,none", "DATA_INFO: made")
TYPES = ("click", "error", "purchase", "signup", "view")


def files(spark, sf) -> DataFrame:
    """A text file for each date and event type (about 65 data lines each at the small scale)."""
    e = frames.events(spark, sf)
    line = F.concat_ws(", ", F.floor(epoch_seconds("ts") % 86_400).cast("string"), F.when(F.col("event_id") % 31 == 0, "-9999").otherwise(F.col("value").cast("string")), F.col("user_id").cast("string"))
    day = F.date_format("ts", "yyyyMMdd")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"])
    made = e.groupBy("event_type", day.alias("day")).agg(lines.alias("data"))
    header = [F.concat(F.lit("Probe "), "event_type") if x == "{title}" else F.lit(x) for x in HEADER]
    name = F.concat("event_type", F.lit("_HU25_"), "day", F.lit("_R0.ict"))
    return made.select(name.alias("file"), F.concat_ws("\n", F.array(*header), "data").alias("content"))


@query
def icartt_scan(spark, sf):
    return icartt.scan(files(spark, sf), prefix_title=True).select("file", "flight_date", "pos", "seconds", "variable", "value")


def spoilt(files: DataFrame) -> DataFrame:
    """Files some of whose data lines can't be read, by their numbers: broken numbers, lost and doubled fields, no time; the files
    of every sixth day have no header."""
    day = F.regexp_extract("file", r"_(\d{8})_", 1).substr(7, 2).cast("int")
    body = F.split("content", "\n")
    bent = F.transform(body, lambda x, i: F.when(i < 15, x).when(i % 11 == 0, F.concat(x, F.lit("x"))).when(i % 13 == 0, F.concat(x, F.lit(", 1"))).when(i % 17 == 0, F.substring_index(x, ",", 2)).when(i % 19 == 0, F.concat(F.lit("t"), x)).otherwise(x))
    return files.select("file", F.when(day % 6 == 0, "lost").otherwise(F.array_join(bent, "\n")).alias("content"))


def on_disk(spark, files: DataFrame) -> DataFrame:
    """The files written as text, one folder each, and read by lines."""
    path = shared_path(spark)
    files.select("file", "content").repartition("file").write.partitionBy("file").text(path)
    return lines.read_lines(spark, path, "part-*", F.regexp_extract("_metadata.file_path", "/file=([^/]+)/", 1))


@query
def icartt_scan_lines(spark, sf):
    """The scan of icartt_scan, by lines and splits."""
    read = on_disk(spark, files(spark, sf))
    return lines.scan(read, lines.headers(read), prefix_title=True).values.select("file", "flight_date", "pos", "seconds", "variable", "value")


@query
def row_quarantine(spark, sf):
    """Data lines that can't be read, by file and reason, and the counts of the whole pass."""
    read = on_disk(spark, spoilt(files(spark, sf)))
    done = lines.scan(read, lines.headers(read))
    each = done.quarantine.groupBy("file", "reason").agg(F.count("*").alias("n"), F.sum("pos").alias("places"))
    kept = done.values.agg(F.count("*").alias("n"), F.sum("pos").alias("places")).select(F.lit("all").alias("file"), F.lit("values").alias("reason"), "n", "places")
    return each.unionByName(kept).withColumns({"n_lines": F.lit(done.counts["n_lines"]), "n_bad": F.lit(done.counts["n_bad"])})


@query
def failures_by_date(spark, sf):
    read = on_disk(spark, spoilt(files(spark, sf)))
    heads = lines.headers(read)
    return lines.failures(heads, lines.scan(read, heads).quarantine)


@query
def icartt_header_vars(spark, sf):
    return icartt.header_variables(files(spark, sf))


@query
def file_select(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    """Pages as files named after their language, day and number; two instruments (languages) and a range of days."""
    number = F.regexp_extract("url", r"/(\d+)", 1)
    day = F.lpad((F.col("page_id") % 40 + 1).cast("string"), 2, "0")
    name = F.concat(F.regexp_extract("url", r"^https?://[a-z.]+/([a-z]{2})/", 1), F.lit("_HU25_202401"), day, F.lit("_R"), number, F.lit(".ict"))
    chosen = icartt.select_files(pages.select("page_id", name.alias("file")), instruments=("fr", "de"), dates=("2024-01-05", "2024-01-25"), year=2024)
    return chosen.select("page_id", "file", "instr", "flight_date")


def fifteen_minutes(spark, sf) -> DataFrame:
    """The timeline of every date in steps of 180 s with each step's mean of sc450 (null: none; events are minutes apart)."""
    e = frames.sensor(spark, sf)
    slots = e.groupBy("flight_date", (F.floor(epoch_seconds("ts") % 86_400 / 180) * 180).cast("int").alias("slot_s")).agg(F.avg("sc450").alias("value"))
    return merge.timeline(e, 180).join(slots, ["flight_date", "slot_s"], "left")


@query
def timeline(spark, sf):
    return merge.timeline(frames.sensor(spark, sf), 600)


@query
def merge_beside(spark, sf):
    long = frames.sensor(spark, sf).select("flight_date", "ts", F.col("event_type").alias("variable"), "value")
    return merge.beside(long, 600, TYPES)


@query
def gap_fill_linear(spark, sf):
    return merge.fill_linear(fifteen_minutes(spark, sf), "value", "filled", 720).select("flight_date", "slot_s", "filled")


@query
def gap_fill_nearest(spark, sf):
    return merge.fill_nearest(fifteen_minutes(spark, sf), "value", "filled", 360).select("flight_date", "slot_s", "filled")


def instruments(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two instruments of different cadence: clicks, and the values of errors and purchases."""
    e = frames.events(spark, sf).select("event_id", "event_type", epoch_seconds("ts").alias("at"), "value", (F.col("user_id") % 3).alias("probe"))
    return e.where("event_type = 'click'").select("event_id", "at", "probe"), e.where("event_type in ('error', 'purchase')").select("at", "value", "probe", "event_id")


def met(spark, sf, direction: str, by: tuple[str, ...] = ()) -> DataFrame:
    left, right = instruments(spark, sf)
    found = merge.asof(left, right, "at", {"other_value": "value", "other_id": "event_id"}, 900, direction, by)
    return found.select("event_id", "other_value", "other_id", "matched_at")


@query
def asof_backward(spark, sf):
    """Each click with the last value of the other instrument in the fifteen minutes up to it."""
    return met(spark, sf, "backward")


@query
def asof_forward(spark, sf):
    """Each click with the first value of the same probe in the fifteen minutes from it on."""
    return met(spark, sf, "forward", ("probe",))


@query
def asof_nearest(spark, sf):
    return met(spark, sf, "nearest")


@query
def stack_on_top(spark, sf):
    e = frames.sensor(spark, sf)
    parts = [e.where(F.col("event_type") == t).select("event_id", F.col("value").alias(f"{t}_value")) for t in TYPES]
    return merge.stack(parts)


@query
def dedupe_keep_first(spark, sf):
    rows = frames.sensor(spark, sf).select("flight_date", F.floor(epoch_seconds("ts") / 600).alias("slot"), "event_id", "value")
    return merge.keep_first(rows, ["flight_date", "slot"], ["event_id"])


@query
def clean_title(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    raw = F.concat(F.lit(" "), "p_name", F.lit(" 5% (a_+_b) --> "), "p_brand", F.lit(".x "))
    return part.select("p_partkey", catalog.clean_title(raw).alias("title"))


@query
def provenance_text(spark, sf):
    facts = frames.events(spark, sf).select(F.col("event_type").alias("title"), F.concat(F.lit("field"), (F.col("user_id") % 3).cast("string")).alias("field"), (F.col("user_id") % 7).cast("string").alias("value"))
    return report.provenance_text(facts)
