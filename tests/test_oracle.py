"""Every query with a SQL twin must give the same rows; the others must run."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.plans import catalog
from tests_common import TABLES, ordered

QUERIES, ORACLES = catalog.queries(), catalog.oracles()
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Plan nodes that pair every row with every other or leave the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    got = [tuple(r) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(kinds)
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    assert ordered(df.columns, got) == ordered(list(kinds), want)


FITTED = [
    "ml13_lasso", "ml15_feature_importance", "ml16_discount_response", "ts11_boosted_recursive",
    "ts12_forecast_comparison", "ts13_fourier_regression", "cl3_cluster_profile", "cl4_principal_axes",
    "sc1_price_scenarios", "sc3_promo_scenarios",
]


@pytest.mark.parametrize("name", FITTED)
def test_fitted_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[0] == "category" and out.count() == 6
