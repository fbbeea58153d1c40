"""Every registered query against its DuckDB oracle on the smallest scale
(the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_queries import ORACLE_SQL
from revscope.plans.registry import queries
from tools.compare_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
ORACLE = {name: sql for name, sql in ORACLE_SQL.items() if name in queries()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    res = con.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(d_cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["parent_asin", "product_title", "store"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_random_or_approximate():
    without = set(queries()) - set(ORACLE)
    assert without == {"product_summary_approx", "text_stats_approx"}
