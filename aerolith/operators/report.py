"""Aggregates behind reports: histograms, closure pairs, quartiles, moving means and the best complete window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.blocks import ROWS, around, at_home, haloed, within
from aerolith.operators.merge import BLOCK
from aerolith.operators.quantiles import of_series, quantiles


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """(bin, n, n_total, median) between the least and greatest value; the last bin is closed; empty bins have no row."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_v"))
    limits = quantiles(known, "_v", [0.5]).first()
    lo, hi, n, median = (limits["least"], limits["greatest"], limits["n"], limits["q"][0]) if limits else (None, None, 0, None)
    number = lambda x: F.lit(x).cast("double")
    at = F.least(F.coalesce(F.floor(F.try_divide((F.col("_v") - number(lo)) * bins, number(hi) - number(lo))), F.lit(0)), F.lit(bins - 1))
    return known.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n")).withColumns({"n_total": F.lit(n).cast("long"), "median": number(median)})


def closure_pairs(df: DataFrame, measured: str, calculated: str, key: Sequence[str]) -> DataFrame:
    return df.where(F.col(measured).isNotNull() & F.col(calculated).isNotNull()).select(*key, measured, calculated)


def composition(windows: DataFrame, counts: Sequence[str], key: str = "window_start") -> DataFrame:
    """(window, reason, n) in long form."""
    return windows.unpivot([key], list(counts), "reason", "n")


def spectrum_quartiles(df: DataFrame, spectrum: str) -> DataFrame:
    """25th, 50th and 75th percentile of each bin, missing values skipped."""
    long = df.select(F.posexplode(spectrum).alias("bin", "v"))
    return quantiles(long, "v", [0.25, 0.5, 0.75], ["bin"]).select("bin", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])


def moving_mean(df: DataFrame, value: str, width: int, out: str, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), size: int = ROWS) -> DataFrame:
    """Centred mean over width rows of the date, in blocks of size rows; an even width reaches one row further back."""
    return around(df, out, F.avg(value), width // 2, width - width // 2 - 1, date, order, size=size)


def best_window(df: DataFrame, signal: str, others: Sequence[str], seconds: int = 60, date: str = "flight_date", at: str = "at", size: int = BLOCK) -> DataFrame:
    """Per date the row with the greatest signal, at least the date's median, around which (within seconds, ends included)
    nothing is missing: neither in the signal nor in the others; without such a row the last of the others is given up,
    and so on. priority counts from 1; the first row on ties, NaN is the greatest signal, rows without a place take no part.
    Neighbourhoods are looked at in blocks of size seconds, by the last gap before and the first one after each row: both
    are running values, so that a row costs the same however many rows its neighbourhood holds."""
    # A frame that ends at the row is carried on from row to row; one that begins there is not, hence the second order.
    past, future = (within(date).orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc(at), F.desc(at)))
    gap = lambda c: F.when(F.col(c).isNull(), F.col(at))
    far = lambda condition: F.coalesce(condition, F.lit(True))
    full = lambda c: far(F.max(gap(c)).over(past) < F.col(at) - seconds) & far(F.min(gap(c)).over(future) > F.col(at) + seconds)
    medians = quantiles(df, signal, [0.5], [date]).select(F.col(date).alias("_date"), F.col("q")[0].alias("_median"))
    blocks = haloed(df.select(date, at, signal, *others).where(F.col(at).isNotNull()), F.col(at), seconds, max(size, seconds))
    checked = at_home(blocks.withColumns({f"_full_{c}": full(c) for c in (signal, *others)})).join(medians, F.col(date).eqNullSafe(F.col("_date")))
    priority = None
    for given_up in range(len(others) + 1):
        kept = others[: len(others) - given_up]
        holds = F.col(f"_full_{signal}")
        for c in kept:
            holds = holds & F.col(f"_full_{c}")
        priority = F.when(holds, given_up + 1) if priority is None else priority.when(holds, given_up + 1)
    usable = checked.withColumn("priority", priority).where(F.col("priority").isNotNull() & (F.col(signal) >= F.col("_median")))
    best = F.max_by(F.struct("priority", at, signal), F.struct(-F.col("priority"), signal, -F.col(at)))
    return usable.groupBy(date).agg(best.alias("b")).select(date, "b.*")


def statistics(df: DataFrame, columns: dict[str, Column], key: Sequence[str] = ()) -> DataFrame:
    """Least, greatest and median of derived series; a group without any value has no row."""
    found = of_series(df, columns, [0.5], key)
    of = lambda n, c: F.max(F.when(F.col("series") == n, c))
    return found.groupBy(*key).agg(*[x for n in columns for x in (of(n, F.col("least")).alias(f"{n}_min"), of(n, F.col("greatest")).alias(f"{n}_max"), of(n, F.col("q")[0]).alias(f"{n}_median"))])


def sufficient_dates(df: DataFrame, series: Sequence[str], least: int = 90, date: str = "flight_date") -> DataFrame:
    """Dates with at least so many values in each series, and the counts."""
    counts = df.groupBy(date).agg(*[F.count(c).alias(f"n_{c}") for c in series])
    for c in series:
        counts = counts.where(F.col(f"n_{c}") >= least)
    return counts


def provenance_text(facts: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """(title: value) lines of facts (title, field, value), each once, in order, per field."""
    lines = F.array_sort(F.collect_set(F.concat(F.col("title"), F.lit(": "), F.col("value"))))
    return facts.groupBy(*key, "field").agg(F.array_join(lines, "\n").alias("text"))
