"""Queries of loaders and products: what is made from the given tables is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.storage import shared_path
from aerolith.functions.timekeys import epoch_seconds
from aerolith.operators import campaign, flights, merge, qc, retrieval, spectra
from aerolith.plans import align_queries, frames, qc_queries, source_queries, spectrum_queries
from aerolith.plans.registry import query
from aerolith.sources import icartt, products, stages, tables

KEY = ("flight_date", "event_id")
#: Instruments of the merge by lines.
TWO = ("click", "view")


def parts(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet")


def varied_files(spark, sf) -> DataFrame:
    """The text files of events with headers that change from day to day; those of every fourth day are broken."""
    files = source_queries.files(spark, sf)
    day = F.regexp_extract("file", r"_(\d{8})_", 1)
    content = F.replace(F.replace("content", F.lit("value, counts"), F.concat(F.lit("value, u"), day)), F.lit("user,none"), F.concat(F.lit("user_"), day, F.lit(", none")))
    return files.select("file", F.when(F.substring(day, 7, 2).cast("int") % 4 == 0, "nothing to see").otherwise(content).alias("content"))


@query
def header_union(spark, sf):
    """First and last header of each instrument."""
    files = varied_files(spark, sf)
    variables = icartt.select_files(files).select("file", "instr", "flight_date").join(icartt.header_variables(files), "file")
    return icartt.schema_union(variables)


@query
def bad_files(spark, sf):
    """Files that can't be read, and the data rows of those that can."""
    files = varied_files(spark, sf)
    good = icartt.scan(files).groupBy("file").agg(F.count("*").alias("n_values"))
    return icartt.bad_files(files).select("file", F.lit(0).alias("n_values")).unionByName(good)


@query
def bins_from_descriptions(spark, sf):
    p = parts(spark, sf)
    text = F.when(F.col("p_size") > 10, F.concat(F.lit("x bin_center_"), F.col("p_size") / 10, F.lit(" um"))).otherwise("none")
    return icartt.bins_from_descriptions(p.select(F.lit("f").alias("file"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), text.alias("description"), F.lit("").alias("standard"))).select("pos", "name", "centre")


def listed(template: str) -> Column:
    """A template with three numbers that rise from the part's size."""
    return F.format_string(template, *[(F.col("p_size") + i).cast("string") for i in range(3)])


@query
def bins_from_edges(spark, sf):
    text = F.concat(listed("Bin Lower Edges (in um) = [%s, %s, %s]\n"), F.format_string("Bin Upper Edges (in um) = [%s, %s, %s]", *[(F.col("p_size") + i).cast("string") for i in (1, 2, 3)]))
    made = parts(spark, sf).select("p_partkey", F.posexplode(icartt.bins_from_edges(text)).alias("pos", "b"))
    return made.select("p_partkey", "pos", "b.centre", "b.lower", "b.upper")


@query
def bins_from_bounds(spark, sf):
    more = lambda d: F.concat_ws(", ", *[(F.col("p_size") * 10 + 10 * i + d).cast("string") for i in range(3)])
    text = F.concat(F.lit("Lower Bounds: "), more(0), F.lit("\nMid points: "), more(5), F.lit("\nUpper Bounds: "), more(10))
    made = parts(spark, sf).select("p_partkey", F.posexplode(icartt.bins_from_bounds(text)).alias("pos", "b"))
    return made.select("p_partkey", "pos", "b.centre", "b.lower", "b.upper")


@query
def bin_match(spark, sf):
    """Parts as bin columns of their brand: small ones have a header of their own name; headers of promoted ones belong to
    another instrument; the packaged table lists every bin."""
    from pyspark.sql import Window

    p = parts(spark, sf).withColumn("pos", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1)
    name = F.concat(F.lit("c"), F.col("p_partkey").cast("string"))
    columns = p.select(F.col("p_brand").alias("tag"), name.alias("name"), "pos")
    tag = F.when(F.col("p_type") == "PROMO", F.concat("p_brand", F.lit("_x"))).otherwise(F.col("p_brand"))
    headers = p.select(tag.alias("tag"), F.when(F.col("p_type") == "SMALL", name).otherwise(F.concat(F.lit("h"), name)).alias("name"), "pos", F.col("p_size").cast("double").alias("centre"))
    packaged = p.select(F.col("p_brand").alias("tag"), "pos", (F.col("p_size") * 2).cast("double").alias("centre"))
    return spectra.match_bins(columns, headers, packaged)


@query
def synthetic_bins(spark, sf):
    bins, radii = spectra.with_synthetic(F.col("psd"), spectrum_queries.RADII)
    made = frames.spectrum(spark, sf).select(*KEY, bins.alias("bins"))
    return made.select(*KEY, F.size("bins").alias("n_bins"), F.get("bins", F.lit(0)).alias("bin_0"), F.get("bins", F.lit(4)).alias("bin_4"), spectra.sum_if_any(F.col("bins")).alias("total"), F.lit(radii[4]).alias("radius_4"))


@query
def bin_table(spark, sf):
    """Sizes of parts as a bin table, through CSV."""
    path = shared_path(spark)
    size = F.col("p_size").cast("double")
    parts(spark, sf).select((size - 0.5).alias("dpl"), size.alias("dpg"), (size + 0.5).alias("dpu"), F.lit("x").alias("note")).distinct().write.option("header", True).csv(path)
    return tables.bin_table(spark, path)


@query
def shift_table_load(spark, sf):
    path = shared_path(spark)
    rows = parts(spark, sf).select(F.col("p_name").alias("variable"), F.col("p_brand").alias("shift_group"), F.concat("p_type", F.lit("|"), "p_name").alias("alignment_variable"), F.when(F.col("p_size") % 3 == 0, "YES").otherwise("NO").alias("apply_time_shift"))
    rows.write.option("header", True).csv(path)
    return tables.shift_table(spark, path).drop("pos")


@query
def family_map(spark, sf):
    """Families by brand as a JSON file with a map."""
    path = shared_path(spark)
    entries = parts(spark, sf).groupBy("p_brand").agg(F.min("p_type").alias("family"))
    whole = entries.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "family"))).alias("title_to_family"), F.lit("x").alias("note"))  # one entry for each brand
    whole.select(F.to_json(F.struct("note", "title_to_family")).alias("value")).write.text(path)
    return tables.family_map(spark, path)


@query
def diagnostics_load(spark, sf):
    path = shared_path(spark)
    align_queries.table(spark, sf).withColumnsRenamed({"flight_date": "date", "grp": "shift_group"}).write.option("header", True).csv(path)
    back = tables.diagnostics(spark, path)
    return back.select("date", "shift_group", "alignment_variable", "n_valid", "optimal_shift_s", "peak_r", "monotonic_halfwidth_s", "decision", "reason", "n_vars_shifted")


@query
def merged_table(spark, sf):
    """Missing values written as NaN come back as null."""
    path = shared_path(spark)
    nan = lambda c: F.coalesce(F.col(c), F.lit(float("nan"))).alias(c)
    products.write_dates(frames.sensor(spark, sf).select(*KEY, nan("sc450"), nan("abs470"), nan("ssa550")), path)
    return tables.merged(spark, path)


@query
def observation_product(spark, sf):
    """Two families, written by date as floats, and put side by side again."""
    path = shared_path(spark)
    rows = qc_queries.masked(spark, sf).withColumn("row_qc_flag", qc.row_flag())
    products.write_observations(rows, path, {"optics": ["sc450", "sc550_dry"], "quality": ["row_qc_flag"]}, ["event_id"], {"sc450": {"units": "Mm-1"}})
    optics, quality = (spark.read.parquet(f"{path}/{f}") for f in ("optics", "quality"))
    units = optics.schema["sc450"].metadata["units"]
    return optics.join(quality, list(KEY)).withColumn("units", F.lit(units))


@query
def windowed_product(spark, sf):
    path = shared_path(spark)
    bins = spark.createDataFrame([(i, d) for i, d in enumerate(spectrum_queries.DIAMETERS)], "pos int, diameter double")
    products.write_windows(qc_queries.hourly(spark, sf), bins, path)
    sizes = spark.read.parquet(f"{path}/psd_bin").agg(F.count("*").alias("n_bins"), F.max("diameter").alias("largest"))
    return spark.read.parquet(f"{path}/windows").select("window_start", "n_valid", "window_qc_flag", "ae_mean").join(sizes)  # one row


@query
def rename_coefficients(spark, sf):
    names = {"sc450_dry_mean": "dry_cal_sca_coef_450_m-1", "sc550_mean": "wet_meas_sca_coef_550_m-1", "ae_mean": "wet_cal_SSA_550_unitless", "abs532_mean": "other"}
    return products.rename_coefficients(qc_queries.hourly(spark, sf).select("window_start", *[F.col(c).alias(n) for c, n in names.items()]))


@query
def narrow_floats(spark, sf):
    return products.narrow(frames.sensor(spark, sf).select(*KEY, "sc450", "abs470", "rh"))


@query
def stage_by_date(spark, sf):
    """A stage table of which every second day is made again with tenfold values; the other days stay."""
    path = shared_path(spark)
    rows = frames.sensor(spark, sf).select(*KEY, "sc450")
    products.write_dates(rows, path)
    products.write_dates(rows.where(F.day("flight_date") % 2 == 0).withColumn("sc450", F.col("sc450") * 10), path)
    return spark.read.parquet(path)


def dilated_stage(rows: DataFrame) -> DataFrame:
    return qc.dilate_global(rows, "cloud_raw", "cloudy").select(*KEY, "cloudy")


@query
def stage_rerun(spark, sf):
    """A stage of cloud masks dilated across dates. The source of the tenth day changes (every row is cloudy): that day is run again,
    and its neighbours with it, in one commit."""
    rows = frames.sensor(spark, sf).select(*KEY, "ts", qc_queries.cloud(frames.sensor(spark, sf)).alias("cloud_raw"))
    days = [str(r["flight_date"]) for r in rows.select("flight_date").distinct().collect()]
    stage = stages.Stage(spark, shared_path(spark))
    stage.replace(dilated_stage(rows), days)
    changed = rows.withColumn("cloud_raw", F.col("cloud_raw") | (F.col("flight_date") == "2024-01-10"))
    stages.rerun(stage, changed, ["2024-01-10"], dilated_stage)
    return stage.read()


BUCKETS = 8


def bucketed(spark, df: DataFrame, label: str) -> DataFrame:
    path = shared_path(spark)
    return products.write_bucketed(df, f"{label}_{path.rsplit('/', 1)[-1]}", ["flight_date", "window_start"], BUCKETS, path)


@query
def window_broadcast_bucketed(spark, sf):
    """window_broadcast over tables that are bucketed by date and window, so that the join shuffles nothing."""
    from aerolith.functions.timekeys import bucket

    rows = frames.sensor(spark, sf).select(F.col("flight_date").cast("string").alias("flight_date"), "event_id", bucket("ts", qc_queries.HOUR).alias("window_start"))
    day = F.date_format(F.timestamp_seconds("window_start"), "yyyy-MM-dd")
    good = qc_queries.hourly(spark, sf).where("window_qc_flag = 0").select(day.alias("flight_date"), "window_start", "ae_mean")
    return flights.broadcast_windows(bucketed(spark, rows, "rows"), bucketed(spark, good, "windows"), ("flight_date", "window_start"), ["ae_mean"])


@query
def assemble_bucketed(spark, sf):
    """assemble over tables that are bucketed by date and window."""
    day = F.date_format(F.timestamp_seconds("window_start"), "yyyy-MM-dd").alias("flight_date")
    own = bucketed(spark, qc_queries.hourly(spark, sf).select(day, "window_start", "window_qc_flag"), "own")
    tried = bucketed(spark, qc_queries.attempts(spark, sf).select(day, "window_start", "attempt_flag_cri", "rri"), "tried")
    return retrieval.assemble(own, tried, ("flight_date", "window_start")).drop("flight_date")


@query
def result_checkpoint(spark, sf):
    path = shared_path(spark)
    products.write_results(qc_queries.attempts(spark, sf), {"window_s": qc_queries.HOUR, "mode": "relative"}, path)
    results, config = products.read_results(spark, path)
    return results.select("window_start", "attempt_flag_cri", "rri", F.lit(config["window_s"]).alias("window_s"), F.lit(config["mode"]).alias("mode"))


@query
def provenance_row(spark, sf):
    from aerolith.plans import flight_queries

    lost = flights.dropped(flights.assign(flight_queries.rows(spark, sf).select("event_id", "at"), flight_queries.spans(spark, sf)))
    instruments = ", ".join(sorted(source_queries.TYPES))
    return products.provenance_row(lost, "Events", qc_queries.HOUR, {"mode": "relative", "min_valid": 5}, "data-presence gaps", instruments, "r2")


@query
def concat_dates(spark, sf):
    """Frames of even and odd days, one of which lacks a column, as one; the place of each row in its date."""
    from pyspark.sql import Window

    rows = frames.sensor(spark, sf).select(*KEY, "ts", "sc450", "abs470")
    even = F.day("flight_date") % 2 == 0
    both = merge.concat_dates([rows.where(even), rows.where(~even).drop("abs470")], ["ts", "event_id"])
    return both.withColumn("place", F.row_number().over(Window.partitionBy("flight_date").orderBy("ts", "event_id"))).drop("ts")


@query
def drop_columns(spark, sf):
    return merge.drop_matching(frames.sensor(spark, sf), ["^abs", "cdp$", "^ts$", "5.0"])


@query
def metadata_merge(spark, sf):
    e = frames.events(spark, sf)
    facts = e.select(F.to_date("ts").alias("d"), F.col("event_type").alias("title"), F.concat(F.lit("field"), (F.col("user_id") % 3).cast("string")).alias("field"), (F.col("user_id") % 7).cast("string").alias("value"))
    odd = F.day("d") % 2 == 1
    return merge.merge_metadata([facts.where(odd), facts.where(~odd).drop("d")])


@query
def campaign_merge(spark, sf):
    """Text files to the merged table in steps of ten minutes."""
    names = [f"Probe_{t}_{v}" for t in source_queries.TYPES for v in ("value", "user")]
    merged, _ = campaign.merge_files(source_queries.files(spark, sf), 600, names, dropped=["_user$"])
    return merged


@query
def campaign_merge_lines(spark, sf):
    """Text files, some spoilt, to the merged table on its whole timeline, with each date's failures."""
    read = source_queries.on_disk(spark, source_queries.spoilt(source_queries.files(spark, sf)))
    done = campaign.merge_lines(read, 600, TWO, dropped=["click_user$"])
    return done.table.join(done.failures, "flight_date")


@query
def campaign_metadata(spark, sf):
    """What the headers of those files say."""
    return campaign.merge_lines(source_queries.on_disk(spark, source_queries.spoilt(source_queries.files(spark, sf))), 600, TWO).metadata


def run_settings() -> campaign.Settings:
    return campaign.Settings(
        scattering=("sc450", "sc550"), dry=("sc450_dry", "sc550_dry"), absorption=("abs532",), diameters_um=[0.01 * 2**i for i in range(frames.N_BINS)], seconds=qc_queries.HOUR, min_valid=qc_queries.LEAST, min_per_bin=qc_queries.LEAST
    )


def run_kernels(spark) -> DataFrame:
    """Three candidates' kernels, which rise with the bin, in SI units; the last channel is absorption."""
    return spark.createDataFrame([(c, i, [(c + 1) * (i + 1) * (b + 1) * 1e-8 for b in range(frames.N_BINS)]) for c in range(3) for i in range(3)], "candidate long, channel int, kernel array<double>")


RESULT = ("window_start", "window_qc_flag", "candidate", "residual", "attempt_flag_cri", "retrieval_error", "retrieval_qc_flag")


@query
def campaign_run(spark, sf):
    """The merged table to retrievals."""
    return campaign.retrieve(frames.spectrum(spark, sf), run_kernels(spark), run_settings()).select(*RESULT)


@query
def campaign_run_first(spark, sf):
    """The same with the first fifty passing windows of the days from the third on; other passing windows don't appear."""
    days = [r["d"] for r in frames.sensor(spark, sf).where(F.day("flight_date") >= 3).select(F.col("flight_date").cast("string").alias("d")).distinct().collect()]
    return campaign.retrieve(frames.spectrum(spark, sf), run_kernels(spark), run_settings(), 50, days).select(*RESULT)


@query
def campaign_products(spark, sf):
    """A run exported and read back: rows of each family by flag, windows, retrievals, bins, flights and provenance, counted."""
    path, s = shared_path(spark), run_settings()
    done = campaign.run(frames.spectrum(spark, sf), run_kernels(spark), s)
    at = done.rows.select("flight_date", epoch_seconds("ts").alias("at"))
    _, spans, lost = flights.segment(at, 600.0)
    families = {"scattering": ["sc450", "sc550_dry", "absent"], "absorption": ["abs470", "abs532"], "none": ["absent"]}
    campaign.export(done, path, families, spans, lost, s, "Events", "data-presence gaps", "all", ["event_id"], {"sc450": {"units": "Mm-1"}}, version="r3")
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    counted = [read(f"observations/{f}").groupBy(F.concat(F.lit(f"{f} flag "), F.col("row_qc_flag")).alias("part")).agg(F.count("*").alias("n"), F.sum(c).alias("total")) for f, c in (("scattering", "sc550_dry"), ("absorption", "abs532"))]
    results, config = products.read_results(spark, path)
    counted.append(results.groupBy(F.concat(F.lit("retrievals flag "), F.col("retrieval_qc_flag")).alias("part")).agg(F.count("*").alias("n"), F.sum("residual").alias("total")))
    counted.append(read("windows").agg(F.count("*").alias("n"), F.sum(F.col("time_centre").cast("double") * 0).alias("total")).select(F.lit("windows").alias("part"), "n", "total"))
    counted.append(read("psd_bin").agg(F.count("*").alias("n"), F.sum("diameter_um").alias("total")).select(F.lit("psd_bin").alias("part"), "n", "total"))
    counted.append(read("flights").agg(F.count("*").alias("n"), F.sum("n_rows").cast("double").alias("total")).select(F.lit("flights").alias("part"), "n", "total"))
    counted.append(read("provenance").select(F.concat(F.lit("provenance "), "version").alias("part"), F.col("n_dropped").alias("n"), F.lit(float(config["seconds"])).alias("total")))
    return merge.stack(counted)


@query
def clock_alignment(spark, sf):
    """Shift table in, shifted table out: group a by its second candidate, b by its own variable; c has no candidate."""
    rows = [("tgt_a", "a", "absent_a|tgt_a", "YES"), ("tgt_b", "b", "tgt_b", "YES"), ("absent_b", "b", "", "YES"), ("ref", "c", "absent_c", "YES"), ("event_id", "d", "tgt_a", "NO")]
    shifts = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "variable string, shift_group string, alignment_variable string, apply_time_shift string, pos int")
    moved, told = campaign.align_clocks(frames.lag_pairs(spark, sf), shifts, "ref", min_valid=align_queries.LEAST)
    counts = told.groupBy("flight_date").agg(F.sum("n_vars_shifted").alias("n_shifted"), F.count_if(F.col("decision") == "SKIP").alias("n_skipped"))
    return moved.select("flight_date", "rn", "event_id", "tgt_a", "tgt_b").join(counts, "flight_date")
