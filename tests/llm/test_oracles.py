"""Queries against their SQL over the test tables."""

import compare
import duckdb
import pytest

from paylake.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert compare.differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []
