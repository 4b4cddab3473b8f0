"""The variable catalogue: families, names, units, measurement basis and shift groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.blocks import band_join

#: Characters of a title that become underscores (fixed values).
TITLE_BAD = " ,.\"*!@#$^&()=?/\\:;~`<>][{}"
#: Units by whole name and by suffix (fixed values).
UNIT_NAMES = {"Latitude": "degrees_north", "Longitude": "degrees_east", "GPS_altitude": "m", "Pressure_altitude": "m"}
UNIT_SUFFIXES = {"_ppm": "ppm", "_ppb": "ppb", "_ppt": "ppt", "_cm3": "cm-3", "_percent": "percent", "_degC": "degC"}
#: Words of titles that don't tell instruments apart (fixed values).
TAG_STOP = (
    "NASA", "HU", "THE", "ON", "FROM", "IN", "SITU", "AND", "OF", "MEASUREMENTS", "DISTRIBUTIONS", "PARTICLE", "SIZE", "AEROSOL",
    "SUBMICRON", "FALCON", "CLOUD",
)


def clean_title(title: Column) -> Column:
    """A title as it stands in column names."""
    out = F.replace(F.replace(F.replace(F.trim(title), F.lit("%"), F.lit("percent")), F.lit("_+_"), F.lit("+")), F.lit("-->"), F.lit("to"))
    return F.translate(out, TITLE_BAD, "_" * len(TITLE_BAD))


def families(names: DataFrame, titles: DataFrame, name: str = "name") -> DataFrame:
    """Each name with the family of the longest title that it begins with (title and underscore), else `other` and its
    first token. titles: title, family (null: the cleaned title). Distinct names are looked up, each by its beginnings up to an
    underscore, and joined back, so repeated rows stay and no name meets titles that it doesn't begin with."""
    prefixes = titles.select("title", F.coalesce("family", clean_title(F.col("title"))).alias("family"))
    distinct = names.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    ends = F.filter(F.sequence(F.lit(1), F.length("_name")), lambda i: F.substring(F.col("_name"), i, F.lit(1)) == "_")
    begun = distinct.select("_name", F.explode(F.transform(ends, lambda i: F.substring(F.col("_name"), F.lit(1), i - 1))).alias("title"))
    best = begun.join(prefixes, "title").groupBy("_name").agg(F.max_by(F.struct("family", "title"), F.length("title")).alias("_b"))
    met = names.join(best, F.col(name) == F.col("_name"), "left")
    return met.select(*[names[c] for c in names.columns], F.coalesce("_b.family", F.lit("other")).alias("family"), F.coalesce("_b.title", F.split(names[name], "_")[0]).alias("title"))


def family_order(present: DataFrame, configured: Sequence[str]) -> DataFrame:
    """(family, place): the configured order first, then the rest by name, `other` last."""
    at = F.array_position(F.array(*[F.lit(c) for c in configured]), F.col("family"))
    key = F.when(F.col("family") == "other", F.lit(2)).when(at == 0, F.lit(1)).otherwise(F.lit(0))
    families_ = present.select("family").distinct()
    return families_.select("family", F.row_number().over(Window.orderBy(key, at, "family")).alias("place"))


def members(assigned: DataFrame, name: str = "name") -> DataFrame:
    return assigned.groupBy("family").agg(F.array_sort(F.collect_list(name)).alias("names"))


def short_name(name: Column, title: Column) -> Column:
    own = F.startswith(name, F.concat(title, F.lit("_"))) & (F.length(title) > 0)
    return F.when(own, F.substring(name, F.length(title) + 2, F.length(name))).otherwise(name)


def guess_units(short: Column) -> Column:
    """Units by whole name, then by suffix (null: unknown)."""
    out = None
    for n, unit in UNIT_NAMES.items():
        out = F.when(short == n, unit) if out is None else out.when(short == n, unit)
    for suffix, unit in UNIT_SUFFIXES.items():
        out = out.when(F.endswith(short, F.lit(suffix)), unit)
    return out


#: Units, and words of the header's notes, that tell a basis (fixed values).
NO_BASIS_UNITS = ("ppm", "ppb", "ppt", "unitless", "percent", "fraction", "second", "degree", "none")
STP_NOTES, AMBIENT_NOTE = ("standard temperature", "stp"), "ambient temperature"


def measurement_basis(standard: Column, name: Column, units: Column, info: Column) -> Column:
    """STP, ambient, not_applicable or unspecified; the first rule that holds decides."""
    text = lambda c: F.lower(F.coalesce(c, F.lit("")))
    std, n, u, i = F.upper(F.trim(F.coalesce(standard, F.lit("")))), text(name), text(units), F.replace(text(info), F.lit("_"), F.lit(" "))
    last = F.element_at(F.split(std, "_"), -1)
    has = lambda c, *words: c.rlike("|".join(words))
    return (
        F.when((last == "STP") | F.replace(std, F.lit("_"), F.lit("")).contains("MASSSTP"), "STP")
        .when(last == "AMB", "ambient")
        .when(n.endswith("_stp") | n.contains("stdpt"), "STP")
        .when(has(u, *NO_BASIS_UNITS) | n.contains("frac"), "not_applicable")
        .when(has(i, *STP_NOTES), "STP")
        .when(i.contains(AMBIENT_NOTE), "ambient")
        .otherwise("unspecified")
    )


def title_tag(title: Column) -> Column:
    """A title's words in capitals on end, else its first eight letters and digits."""
    words = F.split(F.coalesce(title, F.lit("")), "[^A-Za-z0-9]+")
    capital = F.filter(words, lambda w: (F.length(w) >= 2) & (F.upper(w) == w) & ~F.upper(w).isin(*TAG_STOP))
    plain = F.substring(F.regexp_replace(F.when(F.length(title) > 0, title).otherwise("x"), "[^A-Za-z0-9]+", ""), 1, 8)
    return F.when(F.size(capital) > 0, F.array_join(capital, "")).when(F.length(plain) > 0, plain).otherwise("x")


def unique_names(entries: DataFrame) -> DataFrame:
    """family, title, short and unique_name: a short name that its family holds more than once gets its title's tag."""
    several = F.count("*").over(Window.partitionBy("family", "short")) > 1
    return entries.withColumn("unique_name", F.when(several, F.concat_ws("_", "short", title_tag(F.col("title")))).otherwise(F.col("short")))


def shift_group(names: DataFrame, table: DataFrame, name: str = "name") -> DataFrame:
    """Each name with its shift group, `none` where the table lists none."""
    listed = table.select(F.col("variable").alias(name), "shift_group")
    return names.join(listed, name, "left").withColumn("shift_group", F.coalesce("shift_group", F.lit("none")))


def resolve(columns: DataFrame, headers: DataFrame) -> DataFrame:
    """columns (title, short) with units, standard and description of their own title's header, else of any that defines
    the name (the first title by name)."""
    own = headers.select("title", F.col("name").alias("short"), F.struct("units", "standard", "description").alias("own"))
    any_ = headers.groupBy(F.col("name").alias("short")).agg(F.min_by(F.struct("units", "standard", "description"), "title").alias("other"))
    found = columns.join(own, ["title", "short"], "left").join(any_, "short", "left").withColumn("_m", F.coalesce("own", "other"))
    return found.select(*columns.columns, "_m.units", "_m.standard", "_m.description")


def first_rows(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The rows that come first by a number in each group, all of them on ties, null last. Only numbers are aggregated, so a
    task holds a row for each group; the least of a struct with text would make it sort all its rows."""
    least = df.groupBy(*[F.col(c).alias(f"_own_{c}") for c in by]).agg(F.min(order).alias("_least"))
    same = F.col(order).eqNullSafe(F.col("_least"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_own_{c}"))
    return df.join(least, same, "left_semi")


def channel_preference(channels: DataFrame) -> DataFrame:
    """One column per wavelength: total before submicron before others, dry before ambient, then by position."""
    low = F.lower("column")
    kind = F.when(low.contains("total"), 0).when(low.contains("submicron"), 1).otherwise(2)
    ambient = F.when((kind < 2) & low.contains("amb"), 1).otherwise(0)
    ranked = channels.select("wavelength", "column", "pos", (kind * 2 + ambient).alias("_rank"))
    first = first_rows(ranked, ("wavelength", "_rank"), "pos")
    return first.groupBy("wavelength").agg(F.min_by("column", F.struct("_rank", F.col("pos").isNull(), "pos", "column")).alias("column"))


def channel_kind(column: Column, unknown: str) -> Column:
    low = F.lower(column)
    return F.when(low.contains("total_amb"), "total_amb").when(low.contains("submicron_amb"), "submicron_amb").when(low.contains("total"), "total").when(low.contains("submicron"), "submicron").otherwise(unknown)


def wavelength_match(scattering: DataFrame, candidates: DataFrame, within: float = 50) -> DataFrame:
    """(wavelength, other_wavelength, other_column): for wavelengths at most so far apart, the column of the same kind,
    else the total, else the first (null positions last). Both sides: wavelength, column; candidates: pos as well.
    Of the candidates of one wavelength and kind only the first can be anyone's match, so these alone are joined."""
    sc = scattering.select("wavelength", channel_kind(F.col("column"), "total").alias("kind"))
    listed = candidates.select(F.col("wavelength").alias("other_wavelength"), F.col("column").alias("other_column"), "pos", channel_kind(F.col("column"), "unknown").alias("other_kind"))
    other = first_rows(listed, ("other_wavelength", "other_kind"), "pos")
    near = band_join(sc, other, F.col("wavelength"), F.col("other_wavelength"), within)
    rank = F.when(F.col("kind") == F.col("other_kind"), 0).when(F.col("other_kind") == "total", 1).otherwise(2)
    return near.groupBy("wavelength", "other_wavelength").agg(F.min_by("other_column", F.struct(rank, F.col("pos").isNull(), "pos", "other_column")).alias("other_column"))
