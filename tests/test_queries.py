"""Every query with SQL gives the rows DuckDB gives."""

import pytest
from conftest import SF
from oracle import compare, connect

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, duck.execute(SQL[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
