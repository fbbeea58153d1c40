"""Answers to the questions the chat front end advertises (Q3-Q9), as plain
DataFrame plans over the enriched reviews and the feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions.numeric import pct, round_half_up
from revscope.operators.reports import top_satisfaction
from revscope.operators.theme import Stage, sample_reviews


def top_by_satisfaction(competitive: DataFrame, k: int = 5) -> DataFrame:
    """'What are the top 5 products by satisfaction rate?' (Q3)."""
    return top_satisfaction(competitive, min_reviews=None, k=k)


def feedback_for_top_rated(competitive: DataFrame, reviews: DataFrame, k: int = 5, n: int = 3) -> DataFrame:
    """'What do customers say about the top-rated products?' (Q4): the k best
    average ratings joined to their sample review texts."""
    top = (
        competitive.orderBy(
            F.desc_nulls_last("avg_rating"), F.desc("total_reviews"), F.asc("parent_asin"),
            F.asc_nulls_first("product_title"), F.asc_nulls_first("store"), F.asc_nulls_first("main_category"),
            F.asc_nulls_first("price_tier"),
        )
        .limit(k)
        .select("parent_asin", "product_title", "store", "avg_rating", "total_reviews")
    )
    samples = sample_reviews(reviews.join(F.broadcast(top.select("parent_asin")), "parent_asin", "left_semi"), n)
    return top.join(samples, on="parent_asin", how="left")


def surging_products(velocity: DataFrame) -> DataFrame:
    """'Which products have surging momentum?' (Q5): products with at least
    one surging month, their count of such months, peak change and latest surge."""
    return (
        velocity.filter(F.col("momentum") == "Surging")
        .groupBy("parent_asin", "product_title", "store")
        .agg(
            F.count(F.lit(1)).alias("surging_months"),
            F.max("velocity_change_pct").alias("peak_change_pct"),
            F.max("year_month").alias("latest_surge_month"),
        )
    )


def compare_stores(enriched: DataFrame) -> DataFrame:
    """'Compare stores by average rating' (Q6): review-weighted averages."""
    return enriched.groupBy("store").agg(
        F.count_distinct("parent_asin").alias("products"),
        F.count(F.lit(1)).alias("total_reviews"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        pct(F.count_if(F.col("sentiment") == "Positive"), F.count(F.lit(1))).alias("satisfaction_rate"),
    )


def volume_up_sentiment_down(trends: DataFrame, min_reviews: int = 1) -> DataFrame:
    """Store-months whose volume rose against the store's previous month
    while the rating trend is Declining (Q7)."""
    by_store = Window.partitionBy("store").orderBy("year_month")
    return (
        trends.withColumn("prev_review_count", F.lag("review_count", 1).over(by_store))
        .filter(
            (F.col("trend_direction") == "Declining")
            & (F.col("review_count") > F.col("prev_review_count"))
            & (F.col("review_count") >= min_reviews)
        )
        .select("store", "year_month", "review_count", "prev_review_count", "avg_rating", "rating_change")
    )


def compare_categories(enriched: DataFrame) -> DataFrame:
    """Comparison across main categories (Q8)."""
    return enriched.groupBy("main_category").agg(
        F.count_distinct("parent_asin").alias("products"),
        F.count(F.lit(1)).alias("total_reviews"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        pct(F.count_if(F.col("sentiment") == "Positive"), F.count(F.lit(1))).alias("satisfaction_rate"),
        pct(F.count_if(F.col("sentiment") == "Negative"), F.count(F.lit(1))).alias("negative_rate"),
    )


def feedback_for_product(
    enriched: DataFrame, title_like: str, n: int = 3, reviews: DataFrame | None = None, stage: Stage | None = None
) -> DataFrame:
    """'What do customers say about <product>?' (Q9): per matching product,
    review count, rating and up to n sample texts.

    With the raw ``reviews`` that were enriched, no text goes through the
    enrichment join: only the samples' keys are cut to the matching products.
    ``stage`` keeps the products' figures, then what ``sample_reviews`` keeps."""
    matching = enriched.filter(F.col("product_title").contains(title_like))
    stats = matching.groupBy("parent_asin", "product_title", "store").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
    )
    if stage is not None:
        stats = stage(stats, "matching-products")
    only = None if reviews is None else stats.select("parent_asin").distinct()
    samples = sample_reviews(matching if reviews is None else reviews, n, only=only, stage=stage)
    return stats.join(samples, on="parent_asin", how="left")
