"""Every registered query with SQL gives the same rows as DuckDB on the given tables."""

import os

import pytest

import __spark_entry__ as entry_point
from check_oracle import compare, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(entry_point.queries()[name](spark, FOLDER), con, SQL[name]) == ""


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(SQL) <= set(entry_point.queries())
