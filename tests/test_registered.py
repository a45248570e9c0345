"""Every registered query against its SQL, on the smallest tables."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tallyspan.plans.catalog import QUERIES
from tallyspan.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "supplier", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def normal(value):
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else repr(value)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sql, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    relation = sql.sql(entry_point.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    order = [relation.columns.index(c) for c in df.columns]
    expected = sorted([normal(r[i]) for i in order] for r in relation.fetchall())
    got = sorted([normal(v) for v in row] for row in df.collect())
    assert got == expected
    assert got


def test_entry(spark):
    assert entry_point.entry(spark).count() == 4


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()
