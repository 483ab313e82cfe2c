"""Every registered query with SQL gives the rows DuckDB gives on the same tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    same, detail = compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert same, detail


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 44 and df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
