"""Whole runs as compositions of the operators: text files to the merged table, and the merged table to retrievals."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.storage import written
from aerolith.operators import align, merge, qc, retrieval, windows
from aerolith.operators.catalog import clean_title
from aerolith.sources import icartt, lines, products


def merge_files(files: DataFrame, step: int, variables: Sequence[str], prefix_title: bool = True, dropped: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(merged table, bad files) of text files (file, content): all instruments side by side on a timeline of step seconds, by
    flight_date and slot_s, without the columns that a pattern of dropped matches. Each file is read by one task; a file that
    can't be read is listed and the others go on."""
    long = icartt.scan(files, prefix_title)
    slot = (F.floor(F.col("seconds") / step) * step).cast("long")
    wide = long.groupBy("flight_date", slot.alias("slot_s")).pivot("variable", list(variables)).agg(F.avg("value")).dropna("all", subset=list(variables))
    return merge.drop_matching(wide, dropped), icartt.bad_files(files)


@dataclass(frozen=True)
class Merged:
    """table: flight_date, slot_s and a column for each variable, every step of every date that has data; metadata: (title, field,
    value), each once; failures: by date; quarantine: data lines set aside."""

    table: DataFrame
    metadata: DataFrame
    failures: DataFrame
    quarantine: DataFrame


def merge_lines(read: DataFrame, step: int, instruments: Sequence[str] = (), dates: tuple[str, str] | None = None, prefix_title: bool = True, dropped: Sequence[str] = ()) -> Merged:
    """The merged table of text files read by lines (`lines.read_lines`). Variables are those that the headers declare, without
    those that a pattern of dropped matches; a header catalogue is small, so their names are listed by the driver. Files
    of a date that can't be read don't stop the date, nor a date the others; a step has the mean of its rows (of all
    files that declare the variable); rows past the date's midnight are outside its timeline."""
    heads = lines.headers(read)
    chosen = written(icartt.select_files(heads, instruments=instruments, dates=dates).select("file", "content"))
    scanned = lines.scan(read, chosen, prefix_title)
    declared = icartt.header_variables(chosen)
    name = F.concat_ws("_", clean_title(F.col("title")), "name") if prefix_title else F.col("name")
    wanted = [r["v"] for r in declared.select(name.alias("v")).distinct().orderBy("v").collect() if not any(re.search(p, r["v"]) for p in dropped)]
    slot = (F.floor(F.col("seconds") / step) * step).cast("int")
    values = scanned.values.where(F.col("seconds").between(0, 86_399))
    wide = values.groupBy("flight_date", slot.alias("slot_s")).pivot("variable", wanted).agg(F.avg("value"))
    table = merge.timeline(wide, step).join(wide, ["flight_date", "slot_s"], "left")
    told = [declared.select("title", F.concat_ws(".", "name", F.lit(f)).alias("field"), F.col(f).alias("value")) for f in ("units", "standard", "description")]
    comments = icartt.header_comments(chosen).join(icartt.parsed(chosen).where("ok").select("file", "title"), "file").select("title", F.col("key").alias("field"), F.col("text").alias("value"))
    metadata = merge.merge_metadata([*told, comments]).where("value <> ''")
    return Merged(table, metadata, lines.failures(chosen, scanned.quarantine), scanned.quarantine)


@dataclass(frozen=True)
class Settings:
    """Column names and thresholds of a run; the defaults are the published ones."""

    scattering: Sequence[str]
    absorption: Sequence[str]
    dry: Sequence[str]
    diameters_um: Sequence[float]
    rh: str = "rh"
    gamma: str = "gamma"
    ssa: str = "ssa550"
    stability: str = "ae"
    spectrum: str = "psd"
    inlet: str | None = "inlet"
    cloud_numbers: Sequence[str] = ("n_cdp", "n_fcdp")
    cloud_waters: Sequence[str] = ("lwc_cdp", "lwc_fcdp")
    seconds: int = 60
    min_valid: int = 20
    min_per_bin: int = 10
    ae_limit: float = 0.3
    ae_mode: str = "relative"
    tolerance: float = 0.5
    extra: Sequence[str] = field(default_factory=tuple)


def quality(df: DataFrame, s: Settings) -> DataFrame:
    """Rows with dried channels and quality masks."""
    optical = qc.derive_optical(df, s.scattering, s.rh, s.gamma).withColumn("cloud_raw", qc.cloud_raw(s.cloud_numbers, s.cloud_waters, df.columns))
    spread = qc.dilated(optical, F.col("cloud_raw"), "_cloud")
    return qc.row_masks(spread, F.col("_cloud"), s.inlet, f"{s.scattering[0]}_dry", s.ssa).drop("_cloud")


def windowed(rows: DataFrame, s: Settings) -> DataFrame:
    """Windows with counts, statistics, mean spectra and flags, in one aggregation of the rows each for scalars and spectra."""
    channels = tuple(dict.fromkeys((*s.dry, *s.absorption, s.stability, *s.extra)))
    w = windows.aggregate(rows, channels, s.seconds).withColumn("window_qc_flag", windows.quality_flag(s.stability, (*s.dry, *s.absorption), s.min_valid, s.ae_limit, s.ae_mode))
    return w.join(windows.spectrum_means(rows, s.spectrum, len(s.diameters_um), s.seconds, s.min_per_bin), "window_start", "left")


@dataclass(frozen=True)
class Run:
    """What a run leaves: rows with masks, all windows that count, and the windows' retrievals (flags included)."""

    rows: DataFrame
    windows: DataFrame
    results: DataFrame


def retrieve(df: DataFrame, kernels: DataFrame, s: Settings, max_windows: int | None = None, dates: Sequence[str] = ()) -> DataFrame:
    """run()'s results."""
    return run(df, kernels, s, max_windows, dates).results


def run(df: DataFrame, kernels: DataFrame, s: Settings, max_windows: int | None = None, dates: Sequence[str] = ()) -> Run:
    """From the merged table (of the given dates, all without) to flagged windows with their retrieval: quality, windows, gate,
    inputs in SI units, failures, grid search over the dry scattering and the absorption channels, assembly and
    retrieval flag. kernels: in SI units, their channels are positions in (*dry, *absorption).

    With max_windows the first so many passing windows are tried, and the other passing ones aren't in the results. Windows
    are written once, as several steps read them."""
    own = df.where(F.col("flight_date").cast("string").isin(list(dates))) if dates else df
    rows = quality(own, s)
    w = written(windowed(rows, s))
    chosen = windows.first_passing(w, max_windows) if max_windows is not None else w
    si = retrieval.inputs(chosen, s.spectrum, [f"{c}_mean" for c in s.dry], [f"{c}_mean" for c in s.absorption], s.diameters_um)
    tried = retrieval.failures(si, "spectrum")
    channels = [F.get("sca_per_m", F.lit(i)) for i in range(len(s.dry))] + [F.get("abs_per_m", F.lit(i)) for i in range(len(s.absorption))]
    nothing = {"candidate": F.lit(None).cast("long"), "residual": F.lit(None).cast("double")}
    failed = tried.where("retrieval_error is not null").withColumns(nothing)
    measured = tried.where("retrieval_error is null").select("window_start", "spectrum", *[c.alias(f"_m{i}") for i, c in enumerate(channels)])
    found = retrieval.grid_search(measured, [f"_m{i}" for i in range(len(channels))], "spectrum", kernels, s.tolerance).withColumn("retrieval_error", F.lit(None).cast("string"))
    columns = ("window_start", "candidate", "residual", "attempt_flag_cri", "retrieval_error")
    joined = retrieval.assemble(chosen, failed.select(*columns).unionByName(found.select(*columns)))
    results = joined.withColumn("retrieval_qc_flag", retrieval.quality_flag(F.col("window_qc_flag"), F.col("attempt_flag_cri")))
    return Run(rows, chosen, written(results))


def align_clocks(df: DataFrame, shifts: DataFrame, reference: str, date: str = "flight_date", order: str = "rn", min_valid: int = 300, min_rows: int = align.MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """(shifted table, diagnostics) of a merged table and a shift table (variable, shift_group, alignment_variable,
    apply_time_shift, pos): each group's first alignment variable that df has is correlated with the reference, and what the
    decision shifts are the group's variables that df has. A shift table lists the columns of df, so it is read by the driver.
    (date, order) numbers the rows of each date from 1."""
    groups = {r["shift_group"]: r for r in align.shift_groups(shifts).collect()}
    candidates, variables = ({g: list(r[c]) for g, r in groups.items()} for c in ("candidates", "variables"))
    if not groups:
        return df, align.diagnostics_table(df, reference, {"": ["no group"]}, {}, min_valid, min_rows, date).where("false")
    told = written(align.diagnostics_table(df, reference, candidates, variables, min_valid, min_rows, date))
    moved = {g: [v for v in variables[g] if v in df.columns] for g in sorted(variables)}
    return align.apply_shift(df, told, {g: v for g, v in moved.items() if v}, date, order), told


def export(
    done: Run, path: str, members: Mapping[str, Sequence[str]], flights_table: DataFrame, dropped: DataFrame, s: Settings, title: str, source: str, instruments: str,
    key: Sequence[str] = ("ts",), descriptions: Mapping[str, Mapping[str, str]] | None = None, alignment: DataFrame | None = None, version: str = "",
) -> None:
    """The whole product under path: observations/<family> by date, windows and psd_bin, retrievals with their configuration
    (the checkpoint), flights, provenance and, if given, clock_alignment. flights_table and dropped: of flights.segment()."""
    spark = done.results.sparkSession
    known = {f: [c for c in columns if c in done.rows.columns] for f, columns in members.items()}
    products.write_observations(done.rows.withColumn("row_qc_flag", qc.row_flag()), f"{path}/observations", {f: [*c, "row_qc_flag"] for f, c in known.items() if c}, list(key), descriptions)
    bins = spark.createDataFrame([(i, float(d)) for i, d in enumerate(s.diameters_um)], "psd_bin int, diameter_um double")
    products.write_windows(products.narrow(windows.bounds(done.windows, s.seconds)), bins, path)
    products.write_results(products.rename_coefficients(done.results), facts(s), path)
    flights_table.write.mode("overwrite").parquet(f"{path}/flights")
    products.provenance_row(dropped, title, s.seconds, facts(s), source, instruments, version).write.mode("overwrite").parquet(f"{path}/provenance")
    if alignment is not None:
        alignment.write.mode("overwrite").parquet(f"{path}/clock_alignment")


def facts(settings: Settings) -> Mapping:
    """The settings as a mapping, for the provenance row."""
    return {k: list(v) if isinstance(v, tuple) else v for k, v in vars(settings).items()}
