"""Constraints checked while writing, the staged load, and limits of ad-hoc queries."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from revscope.plans.ask import QueryLimits, ask_sql, objections
from revscope.sources import checked

TYPED = StructType([StructField("parent_asin", StringType()), StructField("year_month", DateType()), StructField("reviews", IntegerType()), StructField("rating", DoubleType())])
LINES = ["reviews,parent_asin,rating,year_month", "3.0,P1,4.5,2020-01-01", ",P2,,2020-02-01", "x,P3,4.0,2020-03-01", "7,P4,n/a,soon", "2,P5,9.5,2020-05-01", "1,,3.0,2020-06-01", '5,"P,""6",1.0,']


def test_staged_load_sets_faulty_rows_apart(spark, tmp_path):
    (tmp_path / "v.csv").write_text("\n".join(LINES) + "\n")
    target = str(tmp_path / "velocity")
    checks = checked.not_null("parent_asin") | checked.within("rating", 1, 5)
    report = checked.load_staged(spark, str(tmp_path / "v.csv"), target, TYPED, checks)
    good = {r.parent_asin: r for r in checked.open_checked(spark, target, TYPED).collect()}
    assert set(good) == {"P1", "P2", 'P,"6'} and good["P1"].reviews == 3 and good["P2"].rating is None and str(good["P1"].year_month) == "2020-01-01"
    bad = {r.raw.parent_asin: r for r in checked.quarantined_load(spark, target, TYPED).collect()}
    want = {"P3": ["reviews is no int"], "P4": ["rating is no double", "year_month is no date"], "P5": ["rating out of 1 to 5"], None: ["parent_asin is null"]}
    assert {k: sorted(r.failed_checks) for k, r in bad.items()} == want
    assert bad["P3"].raw.reviews == "x" and bad["P3"].reviews is None and bad["P4"].raw.year_month == "soon"
    assert (report["rows"], report["rejected"]) == (7, 4)
    assert {k: n for k, n in report["failed"].items() if n} == {name: 1 for names in want.values() for name in names}


def test_checks_and_measures_come_from_the_writing_job(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("double").alias("rating"))
    path = str(tmp_path / "t")
    context = spark.sparkContext
    context.setJobGroup("checked", "one write")
    measures = {"least": checked.accepted_only(F.min, "rating"), "greatest": checked.accepted_only(F.max, "rating"), "sum": F.sum("id")}
    report = checked.write_checked(df, path, checked.within("rating", 1, 5) | {"never": F.lit(None).cast("boolean")}, measures)
    jobs = context.statusTracker().getJobIdsForGroup("checked")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert report == {"rows": 1000, "rejected": 500, "failed": {"rating out of 1 to 5": 500, "never": 0}, "measures": {"least": 1.0, "greatest": 5.0, "sum": 499500}}
    assert checked.open_checked(spark, path, df.schema).filter("rating between 1 and 5").count() == 500 == checked.open_checked(spark, path, df.schema).count()
    assert checked.quarantined(spark, path, df.schema).filter("failed_checks[0] = 'rating out of 1 to 5'").count() == 500
    plan = checked.open_checked(spark, path, df.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan
    none = checked.write_checked(df.limit(0), path, checked.not_null("id"))
    assert none["rows"] == 0 == checked.open_checked(spark, path, df.schema).count() == checked.quarantined(spark, path, df.schema).count()
    all_good = checked.write_checked(df, path, {})
    assert all_good["rejected"] == 0 and checked.quarantined(spark, path, df.schema).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("lineitem", "orders", "part")}


REFUSED = [
    "SELECT * FROM lineitem, part",
    "SELECT count(*) FROM orders o JOIN lineitem l ON o.o_orderkey < l.l_orderkey",
    "WITH a AS (SELECT p_partkey FROM part) SELECT (SELECT count(*) FROM a x CROSS JOIN lineitem y) AS n",
    "SELECT * FROM lineitem",
    "SELECT DISTINCT * FROM lineitem",
    "SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
    "SELECT * FROM (SELECT * FROM lineitem ORDER BY l_tax) LIMIT 5",
]
ACCEPTED = [
    "SELECT * FROM lineitem LIMIT 5",
    "SELECT count(*) AS n FROM lineitem",
    "SELECT * FROM lineitem WHERE l_quantity > 45",
    "SELECT l_quantity / m.most AS share FROM lineitem CROSS JOIN (SELECT max(l_quantity) AS most FROM lineitem) m WHERE l_quantity > 45",
    "SELECT p.p_partkey, b.low FROM part p JOIN (VALUES (0, 900.0), (900, 1000.0)) b(low, high) ON p.p_retailprice >= b.low AND p.p_retailprice < b.high",
    "SELECT o.o_orderkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_tax > 0.07 AND o.o_totalprice > 100",
]


def limits(tables):
    size = int(tables["lineitem"]._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return QueryLimits(scan_bytes=size // 4, loop_rows=10)


@pytest.mark.parametrize("sql", REFUSED)
def test_a_costly_query_is_refused(spark, tables, sql):
    with pytest.raises(ValueError, match="refused"):
        ask_sql(spark, tables, sql, limits=limits(tables))


@pytest.mark.parametrize("sql", ACCEPTED)
def test_a_bounded_query_runs(spark, tables, sql):
    answer = ask_sql(spark, tables, sql, limits=limits(tables))
    assert objections(answer, limits(tables)) == []
    answer.count()


def test_limits_can_be_lifted(spark, tables):
    assert ask_sql(spark, tables, "SELECT count(*) AS n FROM part a, part b", limits=None).first().n == tables["part"].count() ** 2
