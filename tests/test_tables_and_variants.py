"""Bucketed tables in use, the variant read, and samples that do not depend on the layout."""

import json

from revscope.operators import reports
from revscope.plans.ask import ask_sql, open_tables
from revscope.plans.registry import ASK_SQL_EXAMPLE, Inputs
from revscope.sources import readers
from revscope.sources.writers import PRODUCT_LAYOUT, create_feature_tables
from tests_support import rows_equal

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_by_product_need_no_shuffle(spark):
    i = Inputs(spark, SF)
    features = {"sentiment_trends": i.trends, "competitive_analysis": i.competitive, "success_prediction": i.prediction, "review_velocity": i.velocity}
    create_feature_tables(features, buckets=8, layout=PRODUCT_LAYOUT)
    tables = open_tables(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        question = """SELECT c.parent_asin, c.total_reviews, s.success_score, v.months
            FROM agg_competitive_analysis c JOIN agg_success_prediction s ON s.parent_asin = c.parent_asin
            JOIN (SELECT parent_asin, count(*) AS months FROM agg_review_velocity GROUP BY parent_asin) v ON v.parent_asin = c.parent_asin"""
        joined = ask_sql(spark, {}, question)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("ShuffleExchange", "Exchange"), plan
        plain = {f"plain_{k}": v for k, v in i.published.items()}
        rows_equal(joined, ask_sql(spark, plain, question.replace("agg_", "plain_agg_")))
        # a filter on the key opens one bucket of eight
        one = tables["agg_review_velocity"].filter("parent_asin = 'P1'").groupBy("parent_asin").count()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        told = one._jdf.queryExecution().explainString(mode)
        assert "SelectedBucketsCount: 1 out of 8" in told and "Exchange" not in told
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in features:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_published_views_are_plans_only(spark, tmp_path):
    import os

    from revscope.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    i = Inputs(spark, SF)
    assert ask_sql(spark, i.published, ASK_SQL_EXAMPLE).count()
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_variant_read_keeps_everything_in_one_pass(spark, tmp_path):
    lines = [
        json.dumps({"parent_asin": "P1", "title": "T", "price": 12.5, "average_rating": 4, "rating_number": "17", "features": ["a", "b"], "color": "red", "size": {"w": 1}}),
        json.dumps({"parent_asin": "P2", "Title": "other case", "title": "T2", "price": "$9.99", "average_rating": "n/a", "features": "not a list"}),
        '{"parent_asin": "P3", "title": ',
        '{"parent_asin": "P4", "parent_asin": "P5"}',
        "[1, 2]",
        "7",
        "",
        "  ",
        json.dumps({}),
    ]
    (tmp_path / "p.json").write_text("\n".join(lines) + "\n")
    df = readers.read_products_variant(spark, str(tmp_path / "p.json"))
    rows = df.collect()
    assert len(rows) == 7
    whole = {r.parent_asin: r for r in rows if r.parent_asin}
    one, two = whole["P1"], whole["P2"]
    assert (one.title, float(one.price), one.average_rating, one.rating_number, one.features) == ("T", 12.5, 4.0, 17, ["a", "b"])
    assert one.undeclared["color"] == "red" and json.loads(one.undeclared["size"]) == {"w": 1} and one._corrupt_record is None
    assert two.title == "T2" and two.undeclared == {"Title": "other case"} and two.price == "$9.99"
    assert two.average_rating is None and two.features is None
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(lines[2:6])
    assert sum(r._corrupt_record is None and r.parent_asin is None for r in rows) == 1  # the empty object
    assert plan_of(df).count("FileScan") == 1
    declared = [f.name for f in readers.PRODUCTS_FULL.fields]
    assert df.columns == [*declared, "undeclared", "_corrupt_record"]
    assert [f.dataType for f in df.schema.fields[: len(declared)]] == [f.dataType for f in readers.PRODUCTS_FULL.fields]


def test_samples_do_not_depend_on_the_layout(spark):
    reviews = Inputs(spark, SF).reviews.select("parent_asin", "user_id", "timestamp", "rating").cache()
    keys = ["parent_asin", "user_id", "timestamp"]
    for take in (lambda df: reports.random_sample(df, 0.2, 7, keys), lambda df: reports.random_per_group(df, "parent_asin", 2, 7, [*keys, "rating"])):
        rows_equal(take(reviews.repartition(7, "rating")), take(reviews.coalesce(1)))
    share = reports.random_sample(reviews, 0.2, 7, keys).count() / reviews.count()
    assert abs(share - 0.2) < 0.03
    assert reports.random_sample(reviews, 1.0).count() == reviews.count() and reports.random_sample(reviews, 0.0).count() == 0
    per = reports.random_per_group(reviews, "parent_asin", 2, 7).groupBy("parent_asin").count().collect()
    assert max(r["count"] for r in per) == 2 and len(per) == reviews.select("parent_asin").distinct().count()
    assert "WindowGroupLimit" in plan_of(reports.random_per_group(reviews, "parent_asin", 2))
    reviews.unpersist()
