"""A product holding a third of all reviews (with a heavily copied text):
the shuffled plan splits the hot join partition and gives the same results
as the broadcast plan."""

import pytest
from pyspark.sql import functions as F

from revscope.operators import competitive, enrich, sentiment, theme, velocity
from revscope.plans.registry import Inputs
from tools.compare_oracle import rows_of

SF = "/root/testdata/sf0.001"


def skewed_reviews(spark):
    i = Inputs(spark, SF)
    base = i.reviews
    hot = (
        base.withColumn("parent_asin", F.lit("P7"))
        .withColumn("text", F.lit("the same copied review text " * 20))
    )
    return base.unionByName(hot), i.products  # P7 now holds half of all rows


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


BUILDERS = {
    "competitive": lambda e: competitive.competitive_analysis(e),
    "trends": lambda e: sentiment.sentiment_trends(e),
    "velocity": lambda e: velocity.velocity_analysis(e),
    "samples": lambda e: theme.sample_reviews(e, 3),
}


def test_hot_product_is_salted_and_results_are_unchanged(spark, no_broadcast):
    reviews, products = skewed_reviews(spark)
    # reference: no salting at all
    expected = {k: _rows(b(enrich.prepare(reviews, products, rows_per_salt=None))) for k, b in BUILDERS.items()}
    salted = enrich.prepare(reviews, products, rows_per_salt=500)
    hot = enrich.hot_products(enrich.review_key_counts(reviews), rows_per_salt=500).collect()
    assert [r.parent_asin for r in hot] == ["P7"] and hot[0].salts >= 10
    got = {k: _rows(b(salted)) for k, b in BUILDERS.items()}
    assert got == expected
    assert salted.count() == enrich.prepare(reviews, products, rows_per_salt=None).count() > reviews.count()

    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [parent_asin" in plan and "_salt" in plan.split("SortMergeJoin [parent_asin")[1].split("]")[0]
    # the hot product's joined rows land in many tasks, not one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tagged = salted.select("parent_asin", F.spark_partition_id().alias("pid"))
        spread = tagged.filter(F.col("parent_asin") == "P7").select("pid").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 1
    top = competitive.competitive_analysis(salted).filter(F.col("parent_asin") == "P7").first()
    assert top.total_reviews * 2 >= reviews.count()


def test_hot_key_list_names_every_large_key_up_to_its_bound(spark):
    counts = spark.range(1000).select(F.concat(F.lit("P"), "id").alias("parent_asin"), F.lit(900_000_000).cast("long").alias("review_rows"))
    hot = enrich.hot_products(counts).collect()
    assert len(hot) == 1000 and {r.salts for r in hot} == {450}  # equal large keys are all hot
    assert enrich.hot_products(counts, most=10).count() == 10


def small_join(spark, dim_rows, rows_per_salt):
    reviews = spark.range(400).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 1, "P1").otherwise(F.concat(F.lit("Q"), F.col("id") % 3)).alias("parent_asin"),
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.col("id").alias("timestamp"),
        F.lit("t").alias("title"),
    )
    dim = spark.createDataFrame(dim_rows, "parent_asin string, product_title string")
    hot = enrich.hot_products(enrich.review_key_counts(reviews), rows_per_salt)
    return enrich.attach_products(reviews, dim, None), enrich.attach_products(reviews, dim, hot)


def test_null_ids_and_duplicate_metadata_give_the_unsalted_result(spark, no_broadcast):
    dims = [("P1", "a"), ("P1", "b"), ("P1", "a"), ("Q0", "c"), (None, "never")]
    plain, salted = small_join(spark, dims, 10)
    assert _rows(salted) == _rows(plain)
    # the reviews without id are spread over tasks
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = salted.filter("parent_asin is null").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


def test_the_salt_reads_no_text_and_lets_filters_reach_the_scan(spark, tmp_path):
    i = Inputs(spark, SF)
    i.reviews.write.parquet(str(tmp_path / "reviews"))
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    enriched = enrich.prepare(reviews, i.products)
    for build in (sentiment.sentiment_trends, velocity.velocity_analysis, theme.theme_prep):
        plan = build(enriched)._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "Relation" in line]
        physical = build(enriched)._jdf.queryExecution().executedPlan().toString()
        schemas = [line.split("ReadSchema: ")[1] for line in physical.splitlines() if "ReadSchema" in line and "user_id" in line]
        assert scans and schemas and not any("text:" in x or "asin:string,title" in x for x in schemas)
    plan = enriched.filter("verified_purchase AND parent_asin = 'P7'").select("rating")._jdf.queryExecution().executedPlan().toString()
    # the plan's text is cut after the second filter's first letters
    assert "EqualTo(verified_purchase,true), EqualTo(p" in plan
