"""Grid search in blocks and leaves, the run's windows, and its products."""

from dataclasses import replace

import numpy as np
import pytest

from aerolith.operators import campaign, retrieval
from aerolith.operators.lut import Table
from aerolith.plans import frames, product_queries


def plain(windows, kernels, measured):
    """window: (candidate, residual) over the channels that count."""
    out = {}
    for key, psd, *values in windows:
        tried = []
        for c in sorted({k[0] for k in kernels}):
            own = [(k, m) for cand, ch, k in kernels if cand == c for m in [values[ch]] if m]
            if own:
                off = [(sum((x or 0) * y for x, y in zip(psd or [], k)) - m) / m for k, m in own]
                tried.append((sum(o * o for o in off) / len(off), c))
        out[key] = min(tried) if tried else (None, None)
    return out


@pytest.mark.parametrize("block_bytes", [1, 500, 1 << 20])
def test_grid_search_in_any_blocks(spark, block_bytes):
    """Channels missing in windows or candidates, zero measurements, missing bins, short spectra, tied candidates."""
    kernels = [(c, i, [0.1 * (c // 2) + i, 0.2, 0.05 * (c // 2)]) for c in range(10) for i in range(2) if (c, i) != (4, 1)]
    windows = [(w, [1.0 + w, None if w % 3 else 2.0, 0.5][: 2 if w == 7 else 3], None if w in (2, 3) else 1.5 + w, 0.0 if w == 3 else None if w == 4 else 2.0 + w) for w in range(12)] + [(99, None, 1.0, 1.0)]
    table = spark.createDataFrame(kernels + [(3, 5, [1.0] * 3), (None, 0, [1.0])], "candidate long, channel int, kernel array<double>")
    df = spark.createDataFrame(windows, "window_start long, psd array<double>, m0 double, m1 double")
    found = {r["window_start"]: r for r in retrieval.grid_search(df, ("m0", "m1"), "psd", table, 0.5, block_bytes).collect()}
    for key, (residual, candidate) in plain(windows, kernels, 2).items():
        assert (found[key]["candidate"], found[key]["residual"]) == (candidate, residual if residual is None else pytest.approx(residual))
        assert found[key]["attempt_flag_cri"] == (2 if residual is not None and residual <= 0.5 else 1)
    assert found[3]["residual"] is None and len(found) == len(windows)


def test_without_kernels_or_windows(spark):
    none = spark.createDataFrame([], "candidate long, channel int, kernel array<double>")
    df = spark.createDataFrame([(1, [1.0], 1.0)], "window_start long, psd array<double>, m0 double")
    assert [tuple(r) for r in retrieval.grid_search(df, ("m0",), "psd", none, 0.5).collect()] == [(1, None, None, 1)]
    some = spark.createDataFrame([(1, 0, [1.0])], "candidate long, channel int, kernel array<double>")
    assert retrieval.grid_search(df.where("false"), ("m0",), "psd", some, 0.5).collect() == []


def test_hundred_thousand_candidates_are_passed_by():
    """A smooth table as of a refractive index grid: the best candidate is that of a search of all, over a few leaves."""
    a, b = (x.ravel() for x in np.meshgrid(np.linspace(1, 2, 500), np.linspace(0, 1, 200)))
    bins = np.arange(1, 13)
    kernels = np.stack([a[:, None] * bins**1.5 + b[:, None], a[:, None] * np.sqrt(bins) * (1 + b[:, None])], axis=1)
    table = Table(np.arange(len(a)), kernels, np.ones((len(a), 2), bool))
    rng = np.random.default_rng(2)
    spectra = rng.uniform(0.5, 2, (40, 12))
    true = rng.integers(0, len(a), 40)
    measured = np.einsum("wb,wcb->wc", spectra, kernels[true]) * rng.uniform(0.999, 1.001, (40, 2))
    residual, candidate = table.best(spectra, measured)
    off = (np.einsum("wb,kcb->wkc", spectra, kernels) - measured[:, None]) / measured[:, None]
    every = (off**2).mean(axis=2)
    assert (candidate == every.argmin(axis=1)).all() and np.allclose(residual, every.min(axis=1))
    assert table.met < 0.1 * 40 * len(a)


def test_grid_search_plan_has_no_nested_loop(spark, small):
    from aerolith.plans import registry

    plan = registry.QUERIES["lut_grid_search"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


def test_untried_windows_do_not_appear(spark, small):
    df, kernels, s = frames.spectrum(spark, small), product_queries.run_kernels(spark), replace(product_queries.run_settings(), seconds=21_600, min_valid=2, min_per_bin=1)
    done = campaign.run(df, kernels, s, max_windows=3)
    flags = {r["window_qc_flag"]: r["n"] for r in done.results.groupBy("window_qc_flag").count().withColumnRenamed("count", "n").collect()}
    every = {r["window_qc_flag"]: r["n"] for r in campaign.run(df, kernels, s).results.groupBy("window_qc_flag").count().withColumnRenamed("count", "n").collect()}
    assert flags.pop(0) == 3 and every.pop(0) > 3 and flags == every
    tried = done.results.where("window_qc_flag = 0")
    assert tried.where("attempt_flag_cri is null").count() == 0
    days = done.results.where("window_qc_flag = 0").selectExpr("date(timestamp_seconds(window_start)) d").distinct().count()
    one = campaign.run(df, kernels, s, dates=["2024-01-04"]).results.selectExpr("string(date(timestamp_seconds(window_start))) d").distinct().collect()
    assert days >= 1 and [r["d"] for r in one] == ["2024-01-04"]
