"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as E
from tessera.plans.compare import compare, duckdb_connection

from conftest import SF0001

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF0001)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(SQL) <= set(E.queries())
    assert set(E.queries()) - set(SQL) == set(E.EXTRA) - set(E.EXTRA_SQL)  # tested beside these operators


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], SQL.get(name), SF0001)
    assert res["match"] in (True, None), res


def test_entry(spark):
    assert E.entry(spark).count() == 1
