"""Sentiment trends per store and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions.labels import trend_direction
from revscope.functions.numeric import pct, round_half_up
from revscope.schemas import SENTIMENT_TRENDS, conform


def monthly_store_counts(enriched: DataFrame) -> DataFrame:
    """store x month review counts and sentiment counts (partial aggregation
    before the shuffle, so a dominant store costs one row per task)."""
    return enriched.groupBy("store", F.col("review_year_month").alias("year_month")).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("rating").alias("avg_rating"),
        F.count_if(F.col("sentiment") == "Positive").alias("positive_count"),
        F.count_if(F.col("sentiment") == "Negative").alias("negative_count"),
        F.count_if(F.col("sentiment") == "Neutral").alias("neutral_count"),
    )


def trends_of(monthly: DataFrame) -> DataFrame:
    """Trend columns over store-month counts (``monthly_store_counts``).

    Month-over-month change of the *unrounded* average rating, rounded to
    3 places, then classified; the average itself is rounded afterwards.  The
    lag looks at the previous existing month of the store (gaps not filled).
    The window runs on the aggregated rows (at most one per store and month)."""
    by_store = Window.partitionBy("store").orderBy("year_month")
    out = (
        monthly.withColumn("positive_rate", pct("positive_count", "review_count"))
        .withColumn("negative_rate", pct("negative_count", "review_count"))
        .withColumn("rating_change", round_half_up(F.col("avg_rating") - F.lag("avg_rating", 1).over(by_store), 3))
        .withColumn("trend_direction", trend_direction("rating_change"))
        .withColumn("avg_rating", round_half_up("avg_rating", 2))
    )
    return conform(out, SENTIMENT_TRENDS)


def sentiment_trends(enriched: DataFrame) -> DataFrame:
    """Sentiment per store and month with its trend (see ``trends_of``)."""
    return trends_of(monthly_store_counts(enriched))
