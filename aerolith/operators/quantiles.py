"""Exact quantiles by distributed selection.

`percentile` keeps a group's distinct values in one task. Here each wanted rank has an open interval of values that holds
it, at first everything. A round takes approximate quantiles of the values inside (mergeable sketches of a fixed size),
puts a narrower interval round the rank and counts what lies below, on and between its ends; counts are exact, so the
narrower interval is too, whatever the sketch's error. A rank on an end is found; values on an end never come back, so
frequent values don't hold a round up. Intervals of at most `small` values are gathered and sorted: no task
ever holds more values of a rank than that. Each round leaves about a hundredth of the values inside, so
ten thousand million values take three rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.storage import written

SMALL, GRID = 500_000, 256


def _met(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join by columns that may be null."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    condition = [left[c].eqNullSafe(named[f"_r_{c}"]) for c in by]
    return left.join(named, condition, how).drop(*[f"_r_{c}" for c in by])


def _inside(values: DataFrame, intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values inside each interval (by, _lo, _hi and more)."""
    own = _met(values, intervals, by)
    return own.where(F.coalesce(F.col("_v") > F.col("_lo"), F.lit(True)) & F.coalesce(F.col("_v") < F.col("_hi"), F.lit(True)))


def _narrowed(values: DataFrame, ranks: DataFrame, by: Sequence[str], grid: int) -> DataFrame:
    """The ranks with narrower intervals, or found."""
    shares = F.array(*[F.lit(i / grid) for i in range(grid + 1)])
    ends = [*by, "_lo", "_hi"]  # ranks that share an interval share its sketch
    sketch = _inside(values, ranks.select(*ends).distinct(), by).groupBy(*ends).agg(F.percentile_approx("_v", shares, 4 * grid).alias("_g"))
    at = (F.col("_t") - F.col("_below")) / F.col("_count") * grid
    low, high = F.get("_g", F.greatest(F.floor(at) - 1, F.lit(0)).cast("int")), F.get("_g", F.least(F.ceil(at) + 1, F.lit(grid)).cast("int"))
    tried = written(_met(ranks, sketch, ends).withColumns({"_a": low, "_b": high}).drop("_g"))
    v, a, b = F.col("_v"), F.col("_a"), F.col("_b")
    counts = _inside(values, tried.select(*ends, "_t", "_a", "_b"), by).groupBy(*by, "_t").agg(
        F.count_if(v < a).alias("_c0"), F.count_if(v == a).alias("_c1"), F.count_if((v > a) & (v < b)).alias("_c2"), F.count_if((v == b) & (b > a)).alias("_c3")
    )
    sums = [F.col("_c0")]
    for c in ("_c1", "_c2", "_c3"):
        sums.append(sums[-1] + F.col(c))
    own = F.col("_t") - F.col("_below")
    before, between, beyond = own < sums[0], (own >= sums[1]) & (own < sums[2]), own >= sums[3]
    counted = _met(tried, counts, [*by, "_t"])
    return counted.select(
        *by, "_t",
        F.when(~(before | between | beyond), F.when(own < sums[1], a).otherwise(b)).alias("_found"),
        F.when(before, F.col("_lo")).when(between, a).otherwise(b).alias("_lo"),
        F.when(before, a).when(between, b).otherwise(F.col("_hi")).alias("_hi"),
        (F.col("_below") + F.when(before, 0).when(between, sums[1]).otherwise(sums[3])).alias("_below"),
        F.when(before, sums[0]).when(between, F.col("_c2")).otherwise(F.col("_count") - sums[3]).alias("_count"),
    )


def intervals(values: DataFrame, sizes: DataFrame, by: Sequence[str], probabilities: Sequence[float], small: int = SMALL, grid: int = GRID) -> DataFrame:
    """by, _t (rank from 0), _found (its value, if known) or its interval (_lo, _hi, ends excluded), with _below values under it
    and _count, at most small, in it. values: by, _v; sizes: by, n."""
    places = F.array_distinct(F.flatten(F.array(*[F.array(F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)) for p in map(float, probabilities)])))
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    ranks = sizes.select(*by, F.explode(places).alias("_t"), none.alias("_found"), none.alias("_lo"), none.alias("_hi"), zero.alias("_below"), F.col("n").alias("_count"))
    ranks = written(ranks)
    wide = F.col("_found").isNull() & (F.col("_count") > small)
    while not ranks.where(wide).isEmpty():
        ranks = written(ranks.where(~wide).unionByName(_narrowed(values, ranks.where(wide), by, grid)))
    return ranks


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), small: int = SMALL, grid: int = GRID) -> DataFrame:
    """by, n, least, greatest, q: the exact quantiles of each group's values, in the order of the probabilities, linear between
    neighbouring values. Nulls don't count, and groups without a value have no row; NaN counts as the greatest value."""
    keys = list(by) or ["_all"]
    own = df if by else df.withColumn("_all", F.lit(0))
    values = written(own.select(*keys, F.col(value).cast("double").alias("_v")).where("_v is not null"))
    sizes = written(values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("greatest")))
    ranks = intervals(values, sizes, keys, probabilities, small, grid)
    rest = ranks.where("_found is null")
    shared = rest.groupBy(*keys, "_lo", "_hi", "_below").agg(F.collect_list("_t").alias("_ts"))  # a handful of ranks
    listed = _inside(values, shared, keys).groupBy(*keys, "_lo", "_hi", "_below").agg(F.sort_array(F.collect_list("_v")).alias("_l"), F.first("_ts").alias("_ts"))
    picked = F.transform("_ts", lambda t: F.struct(t.alias("_t"), F.get("_l", (t - F.col("_below")).cast("int")).alias("_found")))
    gathered = listed.select(*keys, F.explode(picked).alias("_p")).select(*keys, "_p._t", "_p._found")
    found = ranks.where("_found is not null").select(*keys, "_t", "_found").unionByName(gathered)
    maps = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_t", "_found"))).alias("_m"))

    def at(p: float) -> Column:
        place = (F.col("n") - 1) * p
        low, high = F.floor(place), F.ceil(place)
        a, b = F.element_at("_m", low), F.element_at("_m", high)
        return F.when(a.eqNullSafe(b), a).otherwise((high - place) * a + (place - low) * b)

    whole = _met(sizes, maps, keys).withColumn("q", F.array(*[at(float(p)) for p in probabilities]))
    return whole.select(*by, "n", "least", "greatest", "q")


def of_series(df: DataFrame, series: Mapping[str, Column], probabilities: Sequence[float], by: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """quantiles() of several series in one run: by, series, n, least, greatest, q."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("series"), c.cast("double").alias("value")) for name, c in series.items()]))
    long = df.select(*by, each.alias("_s")).select(*by, "_s.series", "_s.value")
    return quantiles(long, "value", probabilities, [*by, "series"], small)
