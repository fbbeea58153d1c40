"""The batch job end to end: JSON inputs -> four Parquet tables, equal to
the registered queries."""

import json

from revscope.plans.job import run_pipeline
from revscope.plans.registry import SUCCESS_VOLUME, Inputs
from tools.compare_oracle import rows_of

SF = "/root/testdata/sf0.001"


def _frame_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_pipeline_matches_registered_queries(spark, tmp_path):
    i = Inputs(spark, SF)
    i.reviews.write.json(str(tmp_path / "reviews"), compression="gzip")
    i.products.select("parent_asin", "title", "main_category", "store", "price", "features", "description",
                      "average_rating", "rating_number").write.json(str(tmp_path / "products"))
    for mode in ("table", "persist"):
        target = tmp_path / f"out-{mode}"
        report = run_pipeline(
            spark, str(tmp_path / "reviews"), str(tmp_path / "products"), str(target), mode=mode,
            min_partitions=4, success_kwargs={"volume_bounds": SUCCESS_VOLUME},
        )
        assert report["rows"]["success_prediction"] == report["rows"]["competitive_analysis"] == i.competitive.count()
        for name, expected in (
            ("sentiment_trends", i.trends),
            ("competitive_analysis", i.competitive),
            ("review_velocity", i.velocity),
            ("success_prediction", i.prediction),
        ):
            got = spark.read.parquet(str(target / name))
            assert got.dtypes == expected.dtypes, name
            assert _frame_rows(got) == _frame_rows(expected), name
        json.dumps(report)


def test_shuffle_partitions_sized_from_input(spark, tmp_path):
    from revscope.plans.job import size_shuffle_partitions

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("x" * 10_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        n = size_shuffle_partitions(spark, [str(tmp_path / "in")], target_bytes=1_000, expansion=2)
        assert n == 20 and spark.conf.get("spark.sql.shuffle.partitions") == "20"
        # never lowered
        assert size_shuffle_partitions(spark, [str(tmp_path / "in")], target_bytes=10**9) == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_command_line(spark, tmp_path):
    from revscope.plans.ask import ask_sql, open_published
    from revscope.plans.job import main

    i = Inputs(spark, SF)
    i.reviews.write.json(str(tmp_path / "reviews"), compression="gzip")
    i.products.write.json(str(tmp_path / "products"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    target, csv = str(tmp_path / "out"), str(tmp_path / "csv")
    assert main([str(tmp_path / "reviews"), str(tmp_path / "products"), target, "--csv", csv]) == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    tables = open_published(spark, target)
    assert _frame_rows(tables["agg_review_velocity"]) == _frame_rows(i.velocity)
    n = ask_sql(spark, {}, "SELECT count(*) AS n FROM agg_competitive_analysis").first().n
    assert n == i.competitive.count()
    from_csv = open_published(spark, csv, csv=True)
    assert from_csv["agg_sentiment_trends"].count() == i.trends.count()


def test_staging_folder(spark, monkeypatch):
    import pytest

    from revscope.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_publish_runs_null_range_and_summary_checks(spark, tmp_path):
    from pyspark.sql import functions as F

    from revscope.plans.job import build_features, failed_checks, publish

    i = Inputs(spark, SF)
    target = str(tmp_path / "tables")
    build_features(i.enriched, spark, target, "none", {"volume_bounds": SUCCESS_VOLUME})
    report = publish(spark, target, str(tmp_path / "csv"))
    assert failed_checks(report) == []
    summary = {r.feature: r for r in report["summary"].collect()}
    assert summary["Competitive Analysis"].row_count == i.competitive.count() and len(summary) == 4
    nulls = {r.table_name: r for r in report["null_checks"].collect()}
    assert nulls["sentiment_trends"].total_rows == i.trends.count() == summary["Sentiment Trends"].row_count
    ranges = {r.metric: r for r in report["range_checks"].collect()}
    assert ranges["positive_rate"].min_value >= 0 and ranges["avg_rating"].max_value <= 5
    assert all(r.same and r.rows for r in report["row_checks"].collect())
    # a value out of range and a table without rows are told
    i.trends.withColumn("positive_rate", F.lit(250.0)).write.mode("overwrite").parquet(f"{target}/sentiment_trends")
    i.velocity.limit(0).write.mode("overwrite").parquet(f"{target}/review_velocity")
    wrong = failed_checks(publish(spark, target, str(tmp_path / "csv")))
    assert any(w.startswith("positive_rate") for w in wrong) and "Review Velocity: no rows" in wrong
    # a table that is not there
    (tmp_path / "none").mkdir()
    report = publish(spark, str(tmp_path / "none"), str(tmp_path / "csv2"))
    assert set(report) == {"status"} and len(failed_checks(report)) == 4
