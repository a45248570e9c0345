"""The registered queries that have SQL, against it."""

import duckdb
import pytest

from tallyspan.llm.catalog import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    expected = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected.select(*df.columns).fetchall(), key=repr)
