"""A third of all lines on one order, part and supplier, in one week."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests_common import TABLES, ordered

NAMES = [
    "b8_fact", "m2_category_kpis", "pr4_elasticity_proxy", "cb2_intensity_quintiles", "cb5_category_co_occurrence",
    "aq3_price_gap_pairs", "w7_missing_weeks", "x20_numeric_profile", "v4_duplicate_keys", "v6_orphans",
    "v18_join_cardinality", "fe6_rolling", "ml11_mutual_information", "er2_error_by_category", "ct4_zero_weeks",
]


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES:
        source = f"read_parquet('{sf_dir}/{t}.parquet')"
        query = f"SELECT * FROM {source}"
        if t == "lineitem":
            query = f"""SELECT * REPLACE (if(hot, 1, l_orderkey) AS l_orderkey, if(hot, 2, l_partkey) AS l_partkey,
                if(hot, 3, l_suppkey) AS l_suppkey, if(hot, TIMESTAMP '1997-05-05', l_shipdate) AS l_shipdate)
                FROM (SELECT *, row_number() OVER () % 3 = 0 AS hot FROM {source})"""
            query = f"SELECT * EXCLUDE (hot) FROM ({query})"
        con.execute(f"COPY ({query}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return str(folder), con


@pytest.fixture(scope="module")
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_input_gives_whole_results(spark, skewed, no_broadcast, name):
    folder, con = skewed
    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert ordered(df.columns, got) == ordered(columns, cursor.fetchall())
