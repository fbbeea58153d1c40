"""Competitive product profile (A10): one aggregate pass per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.functions.dates import span_days
from revscope.functions.numeric import pct, round_half_up
from revscope.schemas import COMPETITIVE_ANALYSIS, conform

PRODUCT_KEYS = ("parent_asin", "product_title", "store", "main_category", "price_tier")


def profile_of(agg: DataFrame) -> DataFrame:
    """The published columns over a product's unrounded aggregates."""
    out = agg.select(
        *PRODUCT_KEYS,
        "total_reviews",
        "unique_reviewers",
        round_half_up("avg_rating").alias("avg_rating"),
        round_half_up("rating_stddev").alias("rating_stddev"),
        "positive_reviews",
        "negative_reviews",
        "neutral_reviews",
        pct("positive_reviews", "total_reviews").alias("satisfaction_rate"),
        pct("negative_reviews", "total_reviews").alias("negative_rate"),
        round_half_up("avg_review_length").alias("avg_review_length"),
        "detailed_reviews",
        "verified_purchases",
        pct("verified_purchases", "total_reviews").alias("verified_rate"),
        round_half_up("avg_helpful_votes").alias("avg_helpful_votes"),
        "first_review_date",
        "last_review_date",
        span_days("first_review_date", "last_review_date").alias("review_span_days"),
    )
    return conform(out, COMPETITIVE_ANALYSIS)


def competitive_analysis(enriched: DataFrame) -> DataFrame:
    """13 aggregates + 4 derived columns.  The single distinct count is
    planned by Spark as (keys, user_id) partial aggregation followed by a
    per-product merge, so a hot product is spread over reviewers first."""
    agg = enriched.groupBy(*PRODUCT_KEYS).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_distinct("user_id").alias("unique_reviewers"),
        F.avg("rating").alias("avg_rating"),
        F.stddev_samp("rating").alias("rating_stddev"),
        F.count_if(F.col("sentiment") == "Positive").alias("positive_reviews"),
        F.count_if(F.col("sentiment") == "Negative").alias("negative_reviews"),
        F.count_if(F.col("sentiment") == "Neutral").alias("neutral_reviews"),
        F.avg("review_length").alias("avg_review_length"),
        F.sum("is_detailed_review").alias("detailed_reviews"),
        F.count_if(F.col("verified_purchase")).alias("verified_purchases"),
        F.avg("helpful_vote").alias("avg_helpful_votes"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
    )
    return profile_of(agg)
