"""Quantiles by distributed selection against percentile."""

import pytest
from pyspark.sql import functions as F

from aerolith.functions.storage import written
from aerolith.operators import report
from aerolith.operators.quantiles import intervals, quantiles

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def kinds():
    """Uniform, heavy-tailed, few values, half of one value, a hot group, small and constant groups; nulls."""
    i, r = F.col("id"), F.rand(5)
    grp = F.when(i % 3 == 0, "hot").when(i % 997 == 0, "few").when(i % 3 == 1, "even").when(i < 4000, None).otherwise("other")
    v = F.when(i % 11 == 0, None).when(grp == "hot", F.when(r < 0.5, 7.0).otherwise(r * 14)).when(grp == "even", F.floor(r * 5)).when(grp == "other", F.exp(r * 300)).otherwise(r - 0.5)
    return grp.alias("grp"), v.cast("double").alias("v")


@pytest.mark.parametrize("small, grid", [(10, 8), (200, 64), (10**6, 256)])
def test_equal_to_percentile(spark, small, grid):
    df = written(spark.range(20_000).select(*kinds()))
    found = {r.grp: (r.n, r.least, r.greatest, *r.q) for r in quantiles(df, "v", PS, ["grp"], small, grid).collect()}
    wanted = df.groupBy("grp").agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"), F.percentile("v", F.array(*map(F.lit, PS))).alias("q"))
    wanted = {r.grp: (r.n, r.a, r.b, *r.q) for r in wanted.collect()}
    assert found.keys() == wanted.keys() and None in found
    assert all(found[g] == pytest.approx(wanted[g], rel=1e-12) for g in wanted)


def test_no_task_holds_more_than_small(spark):
    values = written(spark.range(30_000).select(F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(F.rand(1) * 6).alias("_v")))
    sizes = values.groupBy("g").agg(F.count("*").alias("n"))
    left = intervals(values, sizes, ["g"], [0.25, 0.5, 0.75], small=50, grid=16)
    assert left.where("_found is null").agg(F.max("_count")).first()[0] <= 50
    # The value that half of the rows hold is found by its count, not by gathering it.
    assert left.where("_found = 3.0").count() >= 1


def test_without_key_and_without_values(spark):
    df = spark.createDataFrame([(3.0,), (None,), (1.0,), (2.0,), (float("nan"),)], "v double")
    row = quantiles(df, "v", [0.0, 0.5]).first()
    assert (row.n, row.least, row.q) == (4, 1.0, [1.0, 2.5]) and row.greatest != row.greatest
    assert quantiles(df.where("false"), "v", [0.5]).collect() == []
    assert report.histogram(df.where("v is null"), "v").collect() == []
    assert [tuple(r) for r in report.histogram(df.where("v = 2"), "v").select("bin", "n", "n_total", "median").collect()] == [(0, 1, 1, 2.0)]


@pytest.mark.parametrize("name", ["hist30", "psd_quartiles", "derived_stats"])
def test_no_exact_percentile_in_the_plan(spark, small, name):
    from aerolith.plans import registry

    plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
