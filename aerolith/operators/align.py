"""Clock alignment: lagged correlation per date and group, its peak and shape, the decision, and the shift."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.blocks import ROWS, haloed, within

LAGS, MIN_ROWS = 30, 90
SIGMA, RADIUS = 3.0, 12
EXCLUDED, CONCAVITY = 5, 10
KEY = ("flight_date", "grp")
#: Reasons of dates and groups that have no curve (fixed values).
NO_CANDIDATE, TOO_FEW_ROWS = "no alignment_variable candidate present in DataFrame", "insufficient data for cross-correlation"


def _led(df: DataFrame, reference: str, columns: Sequence[str], date: str, order: str, lags: int, min_rows: int, size: int = ROWS) -> DataFrame:
    """(date, order, r, all) of the rows whose every lag lies inside their date; all: the columns' values at each lag, column
    by column. order counts a date's rows from 1. One window pass over blocks of size rows serves all lags and columns."""
    ordered = within(date).orderBy(order)
    shifted = lambda c, k: F.lead(c, k).over(ordered) if k >= 0 else F.lag(c, -k).over(ordered)
    values = [shifted(f"_c{i}", k).cast("double") for i in range(len(columns)) for k in range(-lags, lags + 1)]
    narrow = df.select(date, order, F.col(reference).alias("r"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    # A halo of min_rows shows whether the date has so many, without a count that rows would have to meet.
    enough, inner = F.max(order).over(within(date)) >= min_rows, F.lead(order, lags).over(ordered).isNotNull() & (F.col(order) > lags)
    rows = haloed(narrow, F.col(order) - 1, max(lags, min_rows), size).select(date, order, "r", "_home", (enough & inner).alias("_inner"), F.array(*values).alias("all"))
    return rows.where("_home and _inner").select(date, order, "r", "all")


def _named(groups: Sequence[str], lags: int) -> tuple[Column, Column]:
    """Group and lag of a place in all."""
    each = 2 * lags + 1
    return F.element_at(F.array(*[F.lit(g) for g in groups]), (F.col("pos") / each).cast("int") + 1), F.col("pos") % each - lags


def lag_pairs(df: DataFrame, reference: str, targets: dict[str, str], date: str = "flight_date", order: str = "rn", lags: int = LAGS, min_rows: int = MIN_ROWS) -> DataFrame:
    """(date, grp, rn, lag, r, t) for the rows whose every lag lies inside their date, so that all lags use the same
    reference rows; dates with fewer than min_rows give none."""
    rows = _led(df, reference, list(targets.values()), date, order, lags, min_rows).select(date, order, "r", F.posexplode("all").alias("pos", "t"))
    grp, lag = _named(list(targets), lags)
    return rows.select(date, grp.alias("grp"), F.col(order).alias("rn"), lag.alias("lag"), "r", "t")


def _sums(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    both = F.col("r").isNotNull() & F.col("t").isNotNull()
    r, t = F.when(both, F.col("r")), F.when(both, F.col("t"))
    sums = pairs.groupBy(*by).agg(F.count(r).alias("n_valid"), F.covar_pop(r, t).alias("cov"), F.stddev_pop(r).alias("sr"), F.stddev_pop(t).alias("st"), F.avg(r * t).alias("dot"))
    usable = (F.col("n_valid") >= 2) & (F.col("sr") > 0) & (F.col("st") > 0)
    return sums.select(*by, "n_valid", F.when(usable, F.try_divide("cov", F.col("sr") * F.col("st"))).alias("corr"), "dot")


def correlation(pairs: DataFrame, by: Sequence[str] = (*KEY, "lag")) -> DataFrame:
    """n_valid, the population correlation (null under two pairs or without variance) and the mean product of each lag."""
    return _sums(pairs, by)


def lag_curves(df: DataFrame, reference: str, targets: dict[str, str], date: str = "flight_date", order: str = "rn", lags: int = LAGS, min_rows: int = MIN_ROWS) -> DataFrame:
    """correlation() of lag_pairs(), by date, grp and lag. Pairs are summed under a number for group and lag, so that what is
    exploded is two numbers wide and a partition sends one row for each number."""
    rows = _led(df, reference, list(targets.values()), date, order, lags, min_rows).select(date, "r", F.posexplode("all").alias("pos", "t"))
    grp, lag = _named(list(targets), lags)
    return _sums(rows, (date, "pos")).select(date, grp.alias("grp"), lag.alias("lag"), "n_valid", "corr", "dot")


def interpolated(curve: DataFrame, value: str = "corr", out: str = "filled", key: Sequence[str] = KEY) -> DataFrame:
    """Gaps of a curve filled linearly between neighbours, flat at the ends."""
    ordered = Window.partitionBy(*key).orderBy("lag")
    past, future = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col("lag"))
    ends = {"_v0": F.last(value, True).over(past), "_l0": F.last(at, True).over(past), "_v1": F.first(value, True).over(future), "_l1": F.first(at, True).over(future)}
    share = F.try_divide(F.col("lag") - F.col("_l0"), F.col("_l1") - F.col("_l0"))
    filled = F.coalesce(F.col(value), F.col("_v0") + (F.col("_v1") - F.col("_v0")) * share, F.col("_v0"), F.col("_v1"))
    return curve.withColumns(ends).withColumn(out, filled).drop(*ends)


def kernel(sigma: float = SIGMA, radius: int = RADIUS) -> list[float]:
    raw = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


def smoothed(curve: DataFrame, value: str = "filled", shown: str = "corr", out: str = "sm", lags: int = LAGS, key: Sequence[str] = KEY) -> DataFrame:
    """Gaussian smoothing with reflected ends; null where shown is null. A curve has 2 * lags + 1 points, so it fits one array."""
    n = 2 * lags + 1
    weights = F.array(*[F.lit(w) for w in kernel()])
    whole = F.array_sort(F.collect_list(F.struct("lag", value)).over(Window.partitionBy(*key)))
    reflect = lambda i: F.when(i < 0, -1 - i).when(i >= n, 2 * n - 1 - i).otherwise(i)
    at = F.col("lag") + lags
    mixed = F.aggregate(
        F.transform(F.sequence(F.lit(-RADIUS), F.lit(RADIUS)), lambda k: F.get(weights, k + RADIUS) * F.get(F.col("_all"), reflect(at + k))[value]),
        F.lit(0.0), lambda acc, x: acc + x,
    )
    return curve.withColumn("_all", whole).withColumn(out, F.when(F.col(shown).isNotNull(), mixed)).drop("_all")


def gradient(value: Column, ordered) -> Column:
    """Central differences, one-sided at the ends."""
    before, after = F.lag(value).over(ordered), F.lead(value).over(ordered)
    first, last = F.lag(F.lit(1)).over(ordered).isNull(), F.lead(F.lit(1)).over(ordered).isNull()
    return F.when(first, after - value).when(last, value - before).otherwise((after - before) / 2)


def shapes(curve: DataFrame, key: Sequence[str] = KEY, excluded: int = EXCLUDED, within: int = CONCAVITY) -> DataFrame:
    """One row per curve (lag, corr, sm, n_valid), all from one partitioning by the key:

    optimal_shift_s, peak_r, peak_r_raw: the lag of the greatest smoothed value (first on ties), that value, the raw one there;
    zero_lag_r, n_valid: at lag 0; second_peak_r, peak_margin: the greatest smoothed value away from the peak, the margin to it;
    left_, right_, monotonic_halfwidth_s: how far the curve falls or stays level on either side of the peak, and the lesser;
    concavity_fraction: share of negative second derivatives near the peak. Curves without any value have nulls.
    """
    whole, ordered = Window.partitionBy(*key), Window.partitionBy(*key).orderBy("lag")
    order = F.when(F.col("sm").isNotNull(), F.struct((-F.col("sm")).alias("m"), "lag"))
    falls = lambda inner: F.coalesce(F.col("sm") <= inner, F.lit(False))
    marked = curve.withColumns({"_p": F.min_by(F.struct("lag", "sm", "corr"), order).over(whole), "_g": gradient(F.col("sm"), ordered), "_l": falls(F.lead("sm").over(ordered)), "_r": falls(F.lag("sm").over(ordered))})
    bent = marked.withColumn("_h", gradient(F.col("_g"), ordered))
    lag, peak, sm = F.col("lag"), F.col("_p.lag"), F.col("sm")
    at_zero = lambda c: F.max(F.when(lag == 0, F.col(c)))
    second = F.max(F.when(F.abs(lag - peak) > excluded, sm))
    left_stop, right_stop = F.max(F.when((lag < peak) & ~F.col("_l"), lag)), F.min(F.when((lag > peak) & ~F.col("_r"), lag))
    left = F.max(peak) - F.coalesce(left_stop + 1, F.min("lag"))
    right = F.coalesce(right_stop - 1, F.max("lag")) - F.max(peak)
    return bent.groupBy(*key).agg(
        F.max(peak).alias("optimal_shift_s"), F.max("_p.sm").alias("peak_r"), F.max("_p.corr").alias("peak_r_raw"), at_zero("sm").alias("zero_lag_r"), at_zero("n_valid").alias("n_valid"),
        second.alias("second_peak_r"), (F.max("_p.sm") - second).alias("peak_margin"),
        left.alias("left_halfwidth_s"), right.alias("right_halfwidth_s"), F.least(left, right).alias("monotonic_halfwidth_s"),
        F.avg(F.when((F.abs(lag - peak) <= within) & F.col("_h").isNotNull(), F.when(F.col("_h") < 0, 1.0).otherwise(0.0))).alias("concavity_fraction"),
    )


def decide(diagnostics: DataFrame, min_valid: int = 300, min_r: float = 0.2, min_halfwidth: int = 5) -> DataFrame:
    """decision (SHIFT or SKIP) and its reasons."""
    few = F.when(F.col("n_valid") < min_valid, F.concat(F.lit("n_valid="), F.col("n_valid").cast("string"), F.lit(f"<{min_valid}")))
    low = F.when(F.coalesce(F.col("peak_r") < min_r, F.lit(True)), F.lit(f"peak_r<{min_r}"))
    narrow = F.when(F.coalesce(F.col("monotonic_halfwidth_s") < min_halfwidth, F.lit(True)), F.lit(f"monotonic_halfwidth_s<{min_halfwidth}"))
    reason = F.concat_ws("; ", few, low, narrow)
    return diagnostics.withColumn("reason", reason).withColumn("decision", F.when(F.col("reason") == "", "SHIFT").otherwise("SKIP"))


def diagnose(df: DataFrame, reference: str, targets: dict[str, str], min_valid: int = 300, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per date and group: peak, shape and decision."""
    return decide(shapes(smoothed(interpolated(lag_curves(df, reference, targets, min_rows=min_rows)))), min_valid)


def diagnostics_table(
    df: DataFrame, reference: str, candidates: dict[str, Sequence[str]], variables: dict[str, Sequence[str]], min_valid: int = 300, min_rows: int = MIN_ROWS, date: str = "flight_date"
) -> DataFrame:
    """diagnose() for every date and group, floats rounded to four places. candidates: each group's alignment variables, of
    which the first that df has is used; variables: what each group shifts. Dates with fewer than min_rows rows, and groups
    none of whose candidates df has (alignment_variable then lists them), are skipped with that reason."""
    picked = {g: next((c for c in names if c in df.columns), None) for g, names in candidates.items()}
    facts = [(g, picked[g] or "|".join(names), picked[g] is not None, sum(v in df.columns for v in variables.get(g, ()))) for g, names in candidates.items()]
    groups = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("grp", "alignment_variable", "present", "n"), fact)]) for fact in facts]))
    every = df.select(date).distinct().select(date, groups.alias("g")).select(date, "g.grp", "g.alignment_variable", F.col("g.present").alias("_present"), F.col("g.n").alias("_n"))
    found = {g: c for g, c in picked.items() if c is not None}
    joined = every.join(diagnose(df, reference, found or {"": reference}, min_valid, min_rows), [date, "grp"], "left")
    floats = ("peak_r", "peak_r_raw", "zero_lag_r", "second_peak_r", "peak_margin", "concavity_fraction")
    shifted = (F.col("decision") == "SHIFT") & (F.col("optimal_shift_s") != 0)
    reason = F.when(~F.col("_present"), F.lit(NO_CANDIDATE)).otherwise(F.coalesce("reason", F.lit(TOO_FEW_ROWS)))
    return joined.select(
        date, "grp", "alignment_variable", F.coalesce("n_valid", F.lit(0)).alias("n_valid"), "optimal_shift_s", *[F.round(c, 4).alias(c) for c in floats],
        "monotonic_halfwidth_s", "left_halfwidth_s", "right_halfwidth_s", F.coalesce("decision", F.lit("SKIP")).alias("decision"),
        reason.alias("reason"), F.when(shifted, F.col("_n")).otherwise(0).alias("n_vars_shifted"),
    )


def apply_shift(df: DataFrame, decisions: DataFrame, groups: dict[str, Sequence[str]], date: str = "flight_date", order: str = "rn") -> DataFrame:
    """Columns of each group moved so that row r holds the value of row r + shift of its date; nulls enter at the edge.
    Only groups decided SHIFT with another shift than 0 move. Each row sends its own columns to its place and each group's
    columns to theirs, and one aggregation by (date, place) puts them together: one pass, whatever the number of groups.
    (date, order) must be unique. decisions has a row for each date and group."""
    moves = decisions.where("decision = 'SHIFT'").groupBy(date).agg(*[F.max(F.when(F.col("grp") == g, F.col("optimal_shift_s"))).alias(f"_k{i}") for i, g in enumerate(groups)])
    moving = [c for columns in groups.values() for c in columns]
    staying = [c for c in df.columns if c not in (date, order, *moving)]
    # What a row sends to a place is one struct of the columns that go there; the others' structs are null, whatever their width.
    packs = [F.struct(F.lit(True).alias("_base"), *staying), *[F.struct(*columns) for columns in groups.values()]]
    kinds = [f.dataType for f in df.select(*packs).schema]
    places = [F.col(order), *[F.col(order) - F.coalesce(f"_k{i}", F.lit(0)) for i in range(len(groups))]]
    only = lambda i: [(p if i == j else F.lit(None).cast(kinds[j])).alias(f"_p{j}") for j, p in enumerate(packs)]
    parts = [F.struct(place.cast("long").alias("_at"), *only(i)) for i, place in enumerate(places)]
    sent = df.join(moves, date, "left").select(date, F.explode(F.array(*parts)).alias("_p")).select(date, "_p.*")
    met = sent.groupBy(date, "_at").agg(*[F.first(f"_p{j}", ignorenulls=True).alias(f"_p{j}") for j in range(len(packs))]).where("_p0 is not null")
    found = met.select(date, F.col("_at").cast(df.schema[order].dataType).alias(order), *[f"_p0.`{c}`" for c in staying], *[f"_p{j}.`{c}`" for j, columns in enumerate(groups.values(), 1) for c in columns])
    return found.select(*df.columns)


def pick_alignment(groups: DataFrame, present: DataFrame) -> DataFrame:
    """(date, grp, picked): the first candidate of each group that a date has (null: none). groups: grp, candidates (array)."""
    listed = groups.select("grp", F.posexplode("candidates").alias("pos", "variable"))
    found = listed.join(present.select("flight_date", "variable").distinct(), "variable")
    best = found.groupBy("flight_date", "grp").agg(F.min_by("variable", "pos").alias("picked"))
    every = present.select("flight_date").distinct().crossJoin(F.broadcast(groups.select("grp")))  # a group list is a handful of names
    return every.join(best, ["flight_date", "grp"], "left")


def shift_groups(table: DataFrame) -> DataFrame:
    """Of a shift table: per group with apply_time_shift = YES, the alignment candidates of its first row and its variables."""
    used = table.where(F.col("apply_time_shift") == "YES")
    split = F.filter(F.transform(F.split(F.min_by("alignment_variable", "pos"), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    return used.groupBy("shift_group").agg(split.alias("candidates"), F.array_sort(F.collect_list("variable")).alias("variables"))


def summary(diagnostics: DataFrame) -> DataFrame:
    """Per group: decisions, and the least, median and greatest applied shift."""
    applied = F.when(F.col("decision") == "SHIFT", F.col("optimal_shift_s"))
    return diagnostics.groupBy("grp").agg(
        F.count_if(F.col("decision") == "SHIFT").alias("n_shift"), F.count_if(F.col("decision") == "SKIP").alias("n_skip"),
        F.min(applied).alias("min_shift"), F.percentile(applied, F.lit(0.5)).alias("median_shift"), F.max(applied).alias("max_shift"),
    )


def skip_reasons(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.where("decision = 'SKIP'").groupBy("reason").agg(F.count("*").alias("n"))


def provenance(diagnostics: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per date: each group's applied shift (0 unless shifted), decision code, peak, valid points, half-width and reason."""
    applied = F.upper("decision").isin("SHIFT", "APPLY")
    rows = diagnostics.select(
        "flight_date", "grp", F.when(applied, F.coalesce(F.col("optimal_shift_s").cast("double"), F.lit(0.0))).otherwise(0.0).alias("applied_shift_s"),
        applied.cast("int").alias("decision_code"), "peak_r", F.coalesce("n_valid", F.lit(0)).alias("n_valid"), F.col("monotonic_halfwidth_s").alias("halfwidth_s"), "reason",
    )
    fields = ("applied_shift_s", "decision_code", "peak_r", "n_valid", "halfwidth_s", "reason")
    return rows.groupBy("flight_date").pivot("grp", list(groups)).agg(*[F.first(c).alias(c) for c in fields])
