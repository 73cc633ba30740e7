"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as contract
from queryset.spark_queries import QUERIES
from queryset.views import TABLES, Inputs

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def test_every_query_has_sql():
    assert contract.oracle_sql().keys() >= QUERIES.keys()
    assert contract.queries().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(row[c]) for c in columns) for row in df.collect())
    cursor = engine.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(tuple(cell(row[p]) for p in places) for row in cursor.fetchall())
    assert got == expected
    assert expected


def test_filter_reaches_the_scan(spark):
    plan = contract.queries()["top_parts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("l_linestatus" in line and "= F" in line for line in scans)
    assert all("l_tax" not in line for line in scans)


def test_views_read_whole_tables(spark):
    inputs = Inputs(spark, SF_DIR)
    assert inputs.listings.count() == inputs.lineitem.count()


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert contract.entry(spark).count() > 0
