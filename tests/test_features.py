"""Feature-table semantics (traps T1-T16 of the survey) on tiny fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revscope.operators import competitive, enrich, sentiment, success, velocity
from tests.fixtures import ms, product, products_df, review, reviews_df


@pytest.fixture()
def small(spark):
    reviews = reviews_df(
        spark,
        [
            review("P1", 5.0, ms(2020, 1, 5), "U1", "x" * 250, True, 3),
            review("P1", 4.0, ms(2020, 1, 9), "U2", "short", False, 0),
            review("P1", 1.0, ms(2020, 3, 2), "U1", None, True, 1),
            review("P2", 2.0, ms(2020, 1, 1), "U3", "meh", True, 0),
            review("P3", None, ms(2020, 2, 1), "U4", "no metadata", True, 0),
        ],
    )
    products = products_df(
        spark,
        [
            product("P1", "Echo Thing", "S1", "$19.99"),
            product("P2", "Other", "S2", None),
            product("P9", "Never reviewed", "S1", "$5"),
        ],
    )
    return reviews, products


def test_left_join_keeps_reviews_without_metadata(small):
    reviews, products = small
    enriched = enrich.prepare(reviews, products)
    assert enriched.count() == 5
    row = enriched.filter(F.col("parent_asin") == "P3").first()
    assert row.store is None and row.product_title is None and row.price_tier == "Unknown"
    assert row.sentiment == "Neutral"


def test_sampled_products_is_semi_join(small):
    reviews, products = small
    sampled = enrich.sampled_products(products, reviews)
    assert sorted(r.parent_asin for r in sampled.collect()) == ["P1", "P2"]
    plan = sampled._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_unmatched_and_match_rate(small):
    reviews, products = small
    assert [r.parent_asin for r in enrich.unmatched_products(reviews, products).collect()] == ["P3"]
    m = enrich.match_rate(reviews, products).first()
    assert (m.sampled_products, m.matched_products, m.missing_products) == (3, 2, 1)
    assert m.match_rate_pct == 66.7


def test_duplicate_metadata_multiplies_reviews(spark, small):
    reviews, products = small
    dup = products.unionByName(products.filter(F.col("parent_asin") == "P2"))
    enriched = enrich.prepare(reviews, dup)
    assert enriched.filter(F.col("parent_asin") == "P2").count() == 2
    from revscope.operators.quality import duplicate_products

    assert [r.parent_asin for r in duplicate_products(dup).collect()] == ["P2"]


def test_competitive_profile_values(small):
    reviews, products = small
    comp = competitive.competitive_analysis(enrich.prepare(reviews, products))
    p1 = comp.filter(F.col("parent_asin") == "P1").first()
    assert p1.total_reviews == 3 and p1.unique_reviewers == 2
    assert p1.avg_rating == 3.33 and p1.rating_stddev == 2.08
    assert (p1.positive_reviews, p1.negative_reviews, p1.neutral_reviews) == (2, 1, 0)
    assert p1.satisfaction_rate == 66.67 and p1.negative_rate == 33.33
    assert p1.avg_review_length == 127.5  # NULL text is not counted
    assert p1.detailed_reviews == 1 and p1.verified_purchases == 2 and p1.verified_rate == 66.67
    assert p1.avg_helpful_votes == 1.33
    assert p1.first_review_date == dt.date(2020, 1, 5) and p1.last_review_date == dt.date(2020, 3, 2)
    assert p1.review_span_days == 57 and p1.price_tier == "Budget (<$20)"


def test_single_review_has_null_score_but_a_category(small):
    reviews, products = small
    comp = competitive.competitive_analysis(enrich.prepare(reviews, products))
    pred = success.success_prediction(comp).filter(F.col("parent_asin") == "P2").first()
    assert pred.rating_stddev is None and pred.success_score is None
    assert pred.success_category == "Underperformer"
    assert pred.review_velocity == 1.0


def test_span_zero_velocity(spark):
    reviews = reviews_df(spark, [review("P1", 5.0, ms(2020, 1, 5, h)) for h in (1, 2, 3)])
    comp = competitive.competitive_analysis(enrich.prepare(reviews, products_df(spark, [product("P1")])))
    pred = success.success_prediction(comp).first()
    assert pred.review_velocity == 3.0


GOLDEN = [
    # satisfaction_rate, rating_stddev, verified_rate, success_score
    (84.20, 1.18, 98.33, 86.10),
    (79.15, 1.29, 94.85, 82.38),
    (80.03, 1.33, 50.84, 69.28),
    (80.17, 1.24, 97.59, 83.91),
    (46.34, 1.69, 75.17, 60.95),
    (94.48, 0.81, 98.14, 92.37),
]


def test_golden_success_scores(spark):
    rows = [
        ("P%d" % i, "t", "s", "c", "tier", 100, 10, 4.0, sd, 1, 1, 1, sat, 1.0, 100.0, 1, 1, ver, 1.0,
         dt.date(2020, 1, 1), dt.date(2020, 1, 2), 1)
        for i, (sat, sd, ver, _) in enumerate(GOLDEN)
    ]
    from revscope.schemas import COMPETITIVE_ANALYSIS

    comp = spark.createDataFrame(rows, COMPETITIVE_ANALYSIS)
    got = {r.parent_asin: r.success_score for r in success.success_prediction(comp).collect()}
    assert [got["P%d" % i] for i in range(len(GOLDEN))] == [g[3] for g in GOLDEN]


def test_sentiment_trends_lag_over_gap_and_first_month(spark):
    reviews = reviews_df(
        spark,
        [
            review("P1", 5.0, ms(2020, 1, 5)),
            review("P1", 3.0, ms(2020, 1, 6)),
            review("P1", 2.0, ms(2020, 3, 1)),
            review("P2", 5.0, ms(2020, 3, 1)),
        ],
    )
    products = products_df(spark, [product("P1", store="S1"), product("P2", store="S2")])
    trends = sentiment.sentiment_trends(enrich.prepare(reviews, products))
    rows = {(r.store, r.year_month): r for r in trends.collect()}
    jan, mar = rows[("S1", dt.date(2020, 1, 1))], rows[("S1", dt.date(2020, 3, 1))]
    assert jan.rating_change is None and jan.trend_direction == "Stable"
    assert mar.rating_change == -2.0 and mar.trend_direction == "Declining"  # compared with January
    assert jan.review_count == 2 and jan.positive_count == 1 and jan.neutral_count == 1
    assert jan.positive_rate == 50.0 and jan.avg_rating == 4.0
    assert rows[("S2", dt.date(2020, 3, 1))].trend_direction == "Stable"


def test_rating_change_uses_unrounded_average(spark):
    # Jan avg 3.333.., Feb avg 3.5: change 0.1666.. -> 0.167 (not 3.5 - 3.33 = 0.17)
    reviews = reviews_df(
        spark,
        [review("P1", r, ms(2020, 1, 2)) for r in (3.0, 3.0, 4.0)] + [review("P1", r, ms(2020, 2, 2)) for r in (3.0, 4.0)],
    )
    trends = sentiment.sentiment_trends(enrich.prepare(reviews, products_df(spark, [product("P1")])))
    feb = trends.filter(F.col("year_month") == dt.date(2020, 2, 1)).first()
    assert feb.rating_change == 0.167 and feb.trend_direction == "Improving"


def test_velocity_first_month_and_smoothing(spark):
    reviews = reviews_df(
        spark,
        [review("P1", 5.0, ms(2020, 1, d)) for d in (1, 2, 3)] + [review("P1", 4.0, ms(2020, 3, d)) for d in range(1, 9)],
    )
    vel = velocity.velocity_analysis(enrich.prepare(reviews, products_df(spark, [product("P1")])))
    rows = {r.year_month: r for r in vel.collect()}
    first, second = rows[dt.date(2020, 1, 1)], rows[dt.date(2020, 3, 1)]
    assert first.prev_month_reviews is None and first.velocity_change_pct is None and first.momentum == "Collapsing"
    assert second.prev_month_reviews == 3 and second.velocity_change == 5
    assert second.velocity_change_pct == 125.0 and second.momentum == "Surging"  # 5 / (3 + 1) * 100


def test_invariants_on_test_tables(spark):
    from revscope.plans.registry import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    comp = i.competitive
    bad = comp.filter(F.col("positive_reviews") + F.col("negative_reviews") + F.col("neutral_reviews") != F.col("total_reviews"))
    assert bad.count() == 0
    # a product id that the metadata repeats multiplies its reviews (left join): 83 here
    multiplied = i.reviews.join(i.products.groupBy("parent_asin").agg(F.count("*").alias("n")), "parent_asin", "left")
    rows = multiplied.agg(F.sum(F.coalesce("n", F.lit(1)))).first()[0]
    assert rows > i.reviews.count()
    assert i.velocity.agg(F.sum("monthly_reviews")).first()[0] == rows
    assert i.trends.agg(F.sum("review_count")).first()[0] == rows
    rates = i.trends.filter((F.col("positive_rate") < 0) | (F.col("positive_rate") > 100))
    assert rates.count() == 0
    firsts = i.velocity.filter(F.col("prev_month_reviews").isNull()).groupBy("parent_asin").count()
    assert firsts.filter("count != 1").count() == 0
    assert firsts.count() == i.velocity.select("parent_asin").distinct().count()


def test_enrichment_join_moves_no_derived_column(spark):
    """What follows from narrow review columns is derived after the join of reviews and products."""
    enriched = enrich.prepare(reviews_df(spark, [review("P1", 5.0, 1)]), products_df(spark, [product("P1")]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stack, seen = [enriched.drop("text")._jdf.queryExecution().sparkPlan()], set()
        while stack:
            at = stack.pop()
            if at.nodeName() == "SortMergeJoin":
                seen |= {at.left().output().apply(k).name() for k in range(at.left().output().size())}
            stack += [at.children().apply(k) for k in range(at.children().size())]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "review_length" in seen and not seen & {"review_date", "review_year_month", "sentiment", "is_detailed_review", "text"}
