"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle import compare, connect, type_differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare(df, con, SQL[name]) is None
    assert type_differences(df, con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
