"""Every registered query that has SQL agrees with it, on the smallest tables."""

import pytest
from check_catalog import compare, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert compare(got, con.execute(ORACLES[name]).fetchdf()) == []


def test_entry_returns_prepared_rows(spark):
    df = entry.entry(spark)
    assert {"spread_scaled", "market_regime", "load_rstd_96"} <= set(df.columns) and df.count() > 0
