"""Remaining traps of the survey (T17, T18, T21, T22) on tiny fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from revscope.operators import enrich, profile, reports, theme
from revscope.schemas import SUCCESS_PREDICTION
from tests.fixtures import ms, product, products_df, review, reviews_df


def test_report_contains_is_case_sensitive_but_exclusion_is_not(spark):
    reviews = reviews_df(spark, [review("P1", 1.0, ms(2020, 1, 1)), review("P2", 1.0, ms(2020, 1, 1))])
    products = products_df(spark, [product("P1", "Widget Pro"), product("P2", "widget pro", store="ACME basics")])
    enriched = enrich.prepare(reviews, products)
    got = [r.parent_asin for r in theme.example_reviews(enriched, "Widget Pro", "Negative", None).collect()]
    assert got == ["P1"]  # T17: reports match case-sensitively
    kept = [r.parent_asin for r in profile.exclude_store(products, "acme").collect()]
    assert kept == ["P1"]  # the sampler's exclusion ignores case


def test_null_store_kept_in_distribution_dropped_in_counts(spark):
    products = products_df(spark, [product("P1", store=None), product("P2", store="S"), product("P3", store="S")])
    dist = {r.store: r.product_count for r in profile.store_distribution(products).collect()}
    assert dist == {None: 1, "S": 2}
    counts = {r.store: r.product_count for r in profile.store_counts(products).collect()}
    assert counts == {"S": 2}  # T21


def test_bottom_report_puts_null_scores_first(spark):
    rows = [
        ("P1", "t", "s", None, "Underperformer", 50.0, None, 50.0, 1.0, 1.0),
        ("P2", "t", "s", 10.0, "Underperformer", 10.0, 1.0, 10.0, 1.0, 1.0),
        ("P3", "t", "s", 90.0, "Top Performer", 90.0, 0.1, 90.0, 1.0, 1.0),
    ]
    pred = spark.createDataFrame(rows, SUCCESS_PREDICTION)
    assert [r.parent_asin for r in reports.bottom_success(pred, 2).collect()] == ["P1", "P2"]  # T22
    assert [r.parent_asin for r in reports.top_success(pred, 2).collect()] == ["P3", "P2"]


def test_length_band_of_whole_texts(spark):
    long_text = "word " * 5000
    reviews = reviews_df(spark, [review("P1", 5.0, ms(2020, 1, 1), text=long_text), review("P1", 5.0, ms(2020, 1, 2), text=None)])
    bands = {r.text_category: r.review_count for r in profile.text_category_distribution(reviews).collect()}
    assert bands == {"Very Long (1000+)": 2}  # T18: NULL text falls to the last band
    stats = profile.text_stats(reviews).first()
    assert stats.max_length == len(long_text) and stats.total_reviews == 1


def test_year_and_date_range_use_utc(spark):
    reviews = reviews_df(spark, [review("P1", 5.0, 1577836799999), review("P1", 5.0, 1577836800000)])
    years = sorted((r.review_year, r.review_count) for r in profile.reviews_by_year(reviews).collect())
    assert years == [(2019, 1), (2020, 1)]
    rng = profile.date_range(reviews).first()
    assert rng.earliest == dt.datetime(2019, 12, 31, 23, 59, 59) and rng.latest == dt.datetime(2020, 1, 1, 0, 0, 0)


def test_sample_reviews_dedupes_copies_and_orders_by_votes(spark):
    rows = [review("P1", 5.0, ms(2020, 1, d), text="same", votes=1) for d in range(1, 20)]
    rows += [review("P1", 5.0, ms(2020, 2, 1), text="best", votes=9), review("P1", 5.0, ms(2020, 2, 2), text="b", votes=1)]
    out = theme.sample_reviews(reviews_df(spark, rows), 3).first()
    assert out.sample_reviews == "best|b|same" and out.sample_count == 3
