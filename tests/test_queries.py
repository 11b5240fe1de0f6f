"""Registered queries against their SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_points
from millrace.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ("customer", "events", "lineitem", "nation", "orders", "part")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(table):
    def text(value):
        return "" if value is None or (isinstance(value, float) and math.isnan(value)) else str(value)

    names = sorted(table.column_names)
    return names, sorted(tuple(text(row[n]) for n in names) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_query_equals_sql(spark, duck, name):
    got = comparable(entry_points.queries()[name](spark, FOLDER).toArrow())
    assert got == comparable(duck.sql(catalog.CHECKS[name]).to_arrow_table())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.CHECKS)
    assert set(catalog.QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
