"""Every registered query against its SQL counterpart, and the driver contract."""

import importlib

import pytest

import compare

from promptloom.plans import QUERIES

entry = importlib.import_module("__spark_entry__")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = compare.spark_rows(entry.queries()[name](spark, SMALL))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result[1]
    else:
        assert compare.difference(result, compare.duckdb_rows(duck, sql)) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 100


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
