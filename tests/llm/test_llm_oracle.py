"""The registered queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from revscope.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, FOLDER).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    key = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert key(got) == key(want)
