"""As-of joins and band joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import blocks, catalog, merge
from aerolith.plans import registry


def plain(left, right, tolerance, direction, by):
    out = []
    for i, at, k in left:
        fit = [(abs(r - at), r, v) for r, v, q in right if at is not None and r is not None and (not by or q == k) and abs(r - at) <= tolerance and (direction == "nearest" or (r <= at if direction == "backward" else r >= at))]
        best = min(fit, key=lambda x: (x[0], x[1], -x[2])) if fit else (None, None, None)
        out.append((i, at, k, best[1], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("by, size, tolerance", [((), 7, 5), (("k",), 14_400, 5), (("k",), 1, 0), ((), 3, 20)])
def test_asof(spark, direction, by, size, tolerance):
    """Equal places, a hot key, null keys, places and rows of either side without a partner; blocks smaller than the tolerance."""
    rnd = random.Random(size)
    key = lambda: rnd.choice(["hot", "hot", "b", None])
    left = [(i, None if i % 40 == 0 else rnd.randrange(-50, 300) / 2, key()) for i in range(150)]
    right = [(None if i % 30 == 0 else rnd.randrange(-50, 300) / 2, i, key()) for i in range(60)]
    l, r = spark.createDataFrame(left, "i long, at double, k string"), spark.createDataFrame(right, "at double, v long, k string")
    found = merge.asof(l, r, "at", {"other": "v"}, tolerance, direction, by, "m", size).select("i", "at", "k", "m", "other")
    assert sorted(map(tuple, found.collect()), key=repr) == plain(left, right, tolerance, direction, by)


def test_asof_of_empty_tables_and_clashing_names(spark):
    l = spark.createDataFrame([(1, 2.0)], "i long, at double")
    r = spark.createDataFrame([], "at double, v long")
    assert [tuple(x) for x in merge.asof(l, r, "at", {"v": "v"}, 1).collect()] == [(1, 2.0, None, None)]
    assert merge.asof(l.where("false"), r, "at", {"v": "v"}, 1).collect() == []
    with pytest.raises(ValueError):
        merge.asof(l, r, "at", {"i": "v"}, 1)
    with pytest.raises(ValueError):
        merge.asof(l, r, "at", {"v": "v"}, 1, "sideways")


@pytest.mark.parametrize("within", [0, 0.5, 3, 50])
def test_band_join(spark, within):
    rnd = random.Random(4)
    a, b = ([rnd.randrange(-40, 40) / 2 for _ in range(60)] + [None] for _ in range(2))
    l, r = (spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"{n}i long, {n} double") for n, xs in (("a", a), ("b", b)))
    found = sorted((x.ai, x.bi) for x in blocks.band_join(l, r, F.col("a"), F.col("b"), within).collect())
    assert found == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x is not None and y is not None and abs(x - y) <= within)


def test_wavelengths_meet_the_first_candidates_only(spark, monkeypatch):
    """Against all pairs; of many candidates one of each wavelength and kind is joined, and no task sorts its rows to find it."""
    rnd, kinds, met = random.Random(9), ["_total", "_submicron", "_total_amb", ""], []
    made = [(rnd.randrange(400, 500, 20), f"c{i}{rnd.choice(kinds)}", None if i % 50 == 0 else 3000 - i) for i in range(3000)]
    kind = lambda c, unknown: "total_amb" if "total_amb" in c else "total" if "total" in c else "submicron" if "submicron" in c else unknown
    scattering, wanted = {w: c for w, c, _ in made[:6]}, []
    for w, c in scattering.items():
        for o in {o for o, _, _ in made if abs(o - w) <= 50}:
            rank = lambda x: 0 if kind(x[1], "unknown") == kind(c, "total") else 1 if kind(x[1], "unknown") == "total" else 2  # noqa: B023, E731
            wanted.append((w, o, min((x for x in made if x[0] == o), key=lambda x: (rank(x), x[2] is None, x[2] or 0, x[1]))[1]))
    monkeypatch.setattr(catalog, "band_join", lambda l, r, *rest: met.append(r) or blocks.band_join(l, r, *rest))
    found = catalog.wavelength_match(spark.createDataFrame([*scattering.items()], "wavelength long, column string"), spark.createDataFrame(made, "wavelength long, column string, pos long"))
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert met[0].count() == 5 * 4 and "SortAggregate" not in met[0]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["wavelength_match", "asof_nearest", "asof_forward"])
def test_no_nested_loop(spark, small, name):
    plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
