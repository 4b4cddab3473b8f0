"""Row-level quality control: humidity correction, cloud masks and their dilation, row masks and their bits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.nulls import exceeds, holds, total
from aerolith.operators.blocks import ROWS, around, positions

ROW_BITS = {"cloudy": 1, "inlet_bad": 2, "low_signal": 4, "low_ssa": 8}


def gamma_adjust(sc: Column, gamma: Column, rh_from: Column, rh_to: Column) -> Column:
    """Scattering at another humidity: sc / exp(gamma * ln((100 - to) / (100 - from))); null where that is undefined."""
    ratio = F.try_divide(100 - rh_to, 100 - rh_from)
    return F.try_divide(sc, F.exp(gamma * F.when(ratio > 0, F.ln(ratio))))


def derive_optical(df: DataFrame, scattering: Sequence[str], rh: str, gamma: str, dry_rh: float = 40.0, wet_rh: float = 80.0, wet_of: str | None = None) -> DataFrame:
    """Dry scattering where the humidity is above dry_rh (else as it is), and one channel at wet_rh."""
    at = F.col(rh)
    dry = {f"{c}_dry": F.when(at > dry_rh, gamma_adjust(F.col(c), F.col(gamma), at, F.lit(dry_rh))).otherwise(F.col(c)) for c in scattering}
    wet_of = wet_of or scattering[0]
    return df.withColumns(dry).withColumn(f"{wet_of}_wet", gamma_adjust(F.col(f"{wet_of}_dry"), F.col(gamma), F.lit(dry_rh), F.lit(wet_rh)))


def cloud_raw(numbers: Sequence[str], waters: Sequence[str], columns: Sequence[str], n_max: float = 1.0, lwc_max: float = 1e-3) -> Column:
    """True where any probe that the table has counts droplets or water; missing values never flag."""
    tests = [exceeds(F.col(c), n_max) for c in numbers if c in columns] + [exceeds(F.col(c), lwc_max) for c in waters if c in columns]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def dilate(flag: Column, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), rows: int = 5) -> Column:
    """True within so many rows of a true row of the same date."""
    return F.max(flag).over(Window.partitionBy(date).orderBy(*order).rowsBetween(-rows, rows))


def dilated(df: DataFrame, flag: Column, out: str, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), rows: int = 5, size: int = ROWS) -> DataFrame:
    """df with out: dilate() of the flag, in blocks of size rows, so that a date of any size is many tasks."""
    return around(df.withColumn("_flag", flag), out, F.max("_flag"), rows, rows, date, order, size=size).drop("_flag")


def dilate_global(df: DataFrame, flag: str, out: str, date: str = "flight_date", order: Sequence[str] = ("ts", "event_id"), rows: int = 5) -> DataFrame:
    """Dilation across dates without a window over everything: dates are numbered on by the counts of those before,
    hits are spread to their neighbours' numbers, and rows are marked by a semi-join. Expects order to follow date."""
    own = positions(df, date, order, out="row_in_date")
    counts = own.groupBy(date).agg(F.count("*").alias("n"))
    before = counts.select(date, F.coalesce(F.sum("n").over(Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = own.join(before, date).withColumn("row_overall", F.col("before") + F.col("row_in_date"))
    hits = numbered.where(flag).select(F.explode(F.sequence(F.col("row_overall") - rows, F.col("row_overall") + rows)).alias("row_overall")).distinct().withColumn(out, F.lit(True))
    return numbered.join(hits, "row_overall", "left").withColumn(out, F.coalesce(out, F.lit(False))).drop("row_in_date", "before", "row_overall")


def row_masks(df: DataFrame, cloud: Column, inlet: str | None, signal: str, ssa: str, signal_min: float = 10.0, ssa_min: float = 0.7) -> DataFrame:
    """cloudy, inlet_bad, low_signal, low_ssa and valid. Missing inlet flags are bad, missing signals low, missing SSA passes."""
    masks = {
        "cloudy": cloud,
        "inlet_bad": F.coalesce(F.col(inlet) != 0, F.lit(True)) if inlet else F.lit(False),
        "low_signal": ~exceeds(F.col(signal), signal_min),
        "low_ssa": holds(F.col(ssa) <= ssa_min),
    }
    return df.withColumns(masks).withColumn("valid", ~(F.col("cloudy") | F.col("inlet_bad") | F.col("low_signal") | F.col("low_ssa")))


def row_flag() -> Column:
    return total(ROW_BITS)


def row_totals(df: DataFrame) -> DataFrame:
    """One row: rows and how many each mask holds."""
    names = [*ROW_BITS, "valid"]
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c)).alias(f"n_{c}") for c in names])


def angstrom(value: Column, from_nm: float, to_nm: float, exponent: float = 1.0) -> Column:
    return value * F.pow(F.lit(to_nm / from_nm), F.lit(-exponent))


def positive_ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive."""
    return F.when(b > 0, F.try_divide(a, b))


def ssa_two_ways(sc: Column, ext: Column, absorption: Column) -> tuple[Column, Column]:
    """Single scattering albedo as sc / ext and as sc / (abs + sc)."""
    return positive_ratio(sc, ext), positive_ratio(sc, absorption + sc)
