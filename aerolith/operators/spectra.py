"""Size spectra as arrays: sums, grids, edges, cross-sections and patterns of missing bins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(bins: Column) -> Column:
    return F.filter(bins, lambda x: x.isNotNull())


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def sum_if_half(bins: Column) -> Column:
    """Sum of the bins; null unless fewer than half are missing."""
    return F.when((F.size(bins) - F.size(present(bins))) / F.size(bins) < 0.5, _sum(present(bins)))


def sum_if_any(bins: Column) -> Column:
    """Sum of the bins; null if all are missing."""
    return F.when(F.size(present(bins)) >= 1, _sum(present(bins)))


def combined_grid(smps: Sequence[tuple[float, float, float]], las: Sequence[tuple[float, float, float]], largest: float = 1.0, inlet: float = 5.0, smallest: float = 0.0) -> list[int]:
    """Positions of the bins (lower, centre, upper) of both instruments on end that are kept."""
    if smps[-1][2] > las[0][0] + 1e-9:
        raise ValueError("the instruments' bins overlap")
    centres = [b[1] for b in (*smps, *las)]
    if any(b <= a for a, b in zip(centres, centres[1:])):
        raise ValueError("bin centres don't increase")
    kept = [i for i, c in enumerate(centres) if smallest <= c <= min(largest, inlet)]
    if len(kept) < 2:
        raise ValueError("fewer than two bins are left")
    return kept


def take(bins: Column, positions: Sequence[int]) -> Column:
    return F.array(*[F.get(bins, F.lit(i)) for i in positions])


def edges(centres: Column) -> Column:
    """Array of (lower, upper): midpoints between neighbours, mirrored at the ends; a lone bin spans 90 to 110 percent."""
    n = F.size(centres)
    at = lambda i: F.get(centres, i)
    lower = lambda x, i: F.when(n == 1, x * 0.9).when(i == 0, x - (at(i + 1) - x) / 2).otherwise((at(i - 1) + x) / 2)
    upper = lambda x, i: F.when(n == 1, x * 1.1).when(i == n - 1, x + (x - at(i - 1)) / 2).otherwise((x + at(i + 1)) / 2)
    return F.transform(centres, lambda x, i: F.struct(lower(x, i).alias("lower"), upper(x, i).alias("upper")))


def bin_name(name: Column) -> tuple[Column, Column]:
    """Tag and number of TAG_BinNN and dNdlogD_NNN_TAG names (null for others)."""
    plain, inverse = r"(?:^|_)([A-Za-z0-9]+)_Bin(\d+)$", r"^dNdlogD_0*(\d+)_([A-Za-z0-9]+)$"  # fixed by the format
    is_plain, is_inverse = name.rlike(plain), name.rlike(inverse)
    tag = F.when(is_plain, F.lower(F.regexp_extract(name, plain, 1))).when(is_inverse, F.lower(F.regexp_extract(name, inverse, 2)))
    number = F.when(is_plain, F.regexp_extract(name, plain, 2)).when(is_inverse, F.regexp_extract(name, inverse, 1)).cast("int")
    return tag, number


def compact(long: DataFrame, key: Sequence[str], tag: str = "tag", number: str = "number", value: str = "value") -> DataFrame:
    """One array per instrument tag, ordered by bin number, from one row per bin; missing values stay in place."""
    ordered = F.array_sort(F.collect_list(F.struct(number, value)))
    return long.groupBy(*key, tag).agg(F.transform(ordered, lambda x: x[value]).alias("bins"))


def log_widths(diameters: Sequence[float]) -> list[float]:
    """log10 widths of bins whose edges are geometric means of neighbours, the outer ones extrapolated."""
    d = list(diameters)
    inner = [math.sqrt(a * b) for a, b in zip(d, d[1:])]
    ends = [d[0] ** 2 / inner[0], *inner, d[-1] ** 2 / inner[-1]] if inner else [d[0] * 0.5, d[0] * 2.0]
    return [math.log10(b) - math.log10(a) for a, b in zip(ends, ends[1:])]


def weighted(bins: Column, weights: Sequence[float]) -> Column:
    return F.zip_with(bins, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)


def cross_section(bins: Column, radii_nm: Sequence[float]) -> Column:
    """pi 1e-6 sum(r^2 N); null if over half of the bins are missing."""
    missing = F.size(bins) - F.size(present(bins))
    total = _sum(present(weighted(bins, [r * r for r in radii_nm])))
    return F.when(missing / F.size(bins) <= 0.5, total * (math.pi * 1e-6))


def without_overlap(smps_radii: Sequence[float], las_radii: Sequence[float], largest: float | None = None) -> list[tuple[str, int, float]]:
    """(instrument, position, radius) by radius: all SMPS bins, LAS bins above them, none above largest."""
    top = max(smps_radii, default=-math.inf)
    both = [("smps", i, r) for i, r in enumerate(smps_radii)] + [("las", i, r) for i, r in enumerate(las_radii) if r > top]
    return sorted((b for b in both if largest is None or b[2] <= largest), key=lambda b: b[2])


def with_synthetic(bins: Column, radii_nm: Sequence[float], n: int = 5) -> tuple[Column, list[float]]:
    """Bins from 1 nm to just under the smallest, geometric, falling linearly with the radius from the smallest bin's value."""
    least = radii_nm[0]
    if least <= 1.0:
        return bins, list(radii_nm)
    ratio = (least * 0.99) ** (1 / (n - 1))
    made = [ratio**k for k in range(n)]
    return F.concat(F.array(*[F.get(bins, F.lit(0)) * (r / least) for r in made]), bins), [*made, *radii_nm]


def pattern(bins: Column) -> Column:
    """Positions of the bins that aren't missing."""
    return F.filter(F.transform(bins, lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())


def common_patterns(df: DataFrame, bins: str, least: int = 5) -> DataFrame:
    """(pattern, n) of patterns with two bins at least that occur least times at least."""
    counted = df.groupBy(pattern(F.col(bins)).alias("pattern")).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= least) & (F.size("pattern") >= 2)).orderBy(F.desc("n"), "pattern")


def match_bins(columns: DataFrame, headers: DataFrame, packaged: DataFrame) -> DataFrame:
    """Sizes of bin columns (tag, name, pos): from the header's bin of that name, else by position if the header lists as
    many bins, else from the packaged table by position if that has as many, else null. headers and packaged: tag, pos,
    centre (headers: name as well)."""
    size = lambda df, out: df.groupBy("tag").agg(F.count("*").alias(out))
    named = headers.select("tag", "name", F.col("centre").alias("_named"))
    placed = lambda df, out: df.select("tag", "pos", F.col("centre").alias(out))
    met = columns.join(named, ["tag", "name"], "left").join(placed(headers, "_placed"), ["tag", "pos"], "left").join(placed(packaged, "_packaged"), ["tag", "pos"], "left")
    for df, out in ((columns, "_n"), (headers, "_h"), (packaged, "_p")):
        met = met.join(size(df, out), "tag", "left")
    centre = F.coalesce("_named", F.when(F.col("_n") == F.col("_h"), F.col("_placed")), F.when(F.col("_n") == F.col("_p"), F.col("_packaged")))
    return met.select("tag", "name", "pos", centre.alias("centre"))
