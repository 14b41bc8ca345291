"""Every query with SQL gives exactly the rows, types and values DuckDB gives."""

import pytest

import __spark_entry__ as entry
from checks.parity import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), connection, SQL[name]) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_yields_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
