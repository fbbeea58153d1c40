"""Whole replacement of tables, and the profile in one scan."""

import os

import pytest
from pyspark.sql import functions as F

from revscope.operators import profile
from revscope.plans.registry import Inputs
from revscope.sources.writers import current_version, open_version, replace_version
from tests_support import rows_equal

SF = "/root/testdata/sf0.001"


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "table")
    assert current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        open_version(spark, path)
    first = replace_version(spark, path, spark.range(10).withColumn("v", F.lit(1)))
    reader = open_version(spark, path)
    # the new rows may come from the table itself
    second = replace_version(spark, path, open_version(spark, path).withColumn("v", F.lit(2)).unionByName(spark.range(5).withColumn("v", F.lit(2))))
    assert [tuple(r) for r in reader.groupBy("v").count().collect()] == [(1, 10)]
    assert [tuple(r) for r in open_version(spark, path).groupBy("v").count().collect()] == [(2, 15)]
    assert current_version(spark, path) == second and open_version(spark, path, first).count() == 10
    third = replace_version(spark, path, spark.range(3).withColumn("v", F.lit(3)))
    assert sorted(x for x in os.listdir(path) if x.startswith("v")) == [second, third]  # the oldest went


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "table")
    old = replace_version(spark, path, spark.range(4))
    bad = spark.range(100).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        replace_version(spark, path, bad)
    assert current_version(spark, path) == old and open_version(spark, path).count() == 4
    replace_version(spark, path, spark.range(6).withColumn("v", F.lit(1)), keep=1, partition_by=["id"])
    assert open_version(spark, path).count() == 6
    assert len([x for x in os.listdir(path) if x.startswith("v")]) == 1  # what the failed write left is gone too
    with pytest.raises(ValueError):
        replace_version(spark, path, spark.range(1), keep=0)


def test_one_scan_makes_six_reports(spark, tmp_path):
    Inputs(spark, SF).reviews.write.parquet(str(tmp_path / "reviews"))
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    whole = profile.review_profile(reviews)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and "partial_count" in plan
    carried = [line for line in plan.splitlines() if "Expand" in line]
    assert carried and " text#" not in carried[0]
    for report, want in (
        ("rating", profile.rating_distribution(reviews)),
        ("text_category", profile.text_category_distribution(reviews)),
        ("review_year", profile.reviews_by_year(reviews)),
        ("verified", profile.verified_distribution(reviews)),
        ("date_range", profile.date_range(reviews)),
        ("helpfulness", profile.helpfulness_stats(reviews)),
    ):
        got = profile.profile_report(whole, report)
        assert [t for _, t in got.dtypes] == [t for _, t in want.dtypes], report
        rows_equal(got, want)
    assert profile.review_profile(reviews.limit(0)).filter("report <> 'total'").count() == 0
