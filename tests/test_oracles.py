"""Every registered query against DuckDB on the smallest tables."""

import duckdb
import pytest

from aerolith.plans import oracles, registry

TABLES = ("part", "events", "pages", "embeddings")


def rounded(v):
    return (None if v != v else round(v, 5)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_as_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    found = registry.QUERIES[name](spark, small)
    wanted = con.sql(oracles.SQL[name])
    columns = sorted(found.columns)
    assert sorted(wanted.columns) == columns
    at = [wanted.columns.index(c) for c in columns]
    rows = lambda xs: sorted(xs, key=repr)
    assert rows(tuple(rounded(r[c]) for c in columns) for r in found.collect()) == rows(tuple(rounded(r[i]) for i in at) for r in wanted.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.SQL)


@pytest.mark.parametrize("name", ["window_qc_flag", "lag_correlation", "shift_diagnostics", "interval_assign", "sigma_geo", "icartt_scan"])
def test_no_python_in_the_plan(spark, small, name):
    plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan
