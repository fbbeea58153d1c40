"""Review velocity per product and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions.labels import momentum
from revscope.functions.numeric import round_half_up, smoothed_pct
from revscope.schemas import REVIEW_VELOCITY, conform


def velocity_of(monthly: DataFrame) -> DataFrame:
    """Momentum columns over product-month counts: previous existing month's
    count, change and smoothed change percentage.  The window is keyed by product
    only (as published), ordered by month with title and store as tiebreaks so
    duplicated metadata cannot make the lag nondeterministic.  The first month of
    a product has a NULL percentage and is therefore 'Collapsing'."""
    by_product = Window.partitionBy("parent_asin").orderBy("year_month", "product_title", "store")
    out = (
        monthly.withColumn("prev_month_reviews", F.lag("monthly_reviews", 1).over(by_product))
        .withColumn("velocity_change", F.col("monthly_reviews") - F.col("prev_month_reviews"))
        .withColumn("velocity_change_pct", smoothed_pct("monthly_reviews", "prev_month_reviews"))
        .withColumn("momentum", momentum("velocity_change_pct"))
        .withColumn("monthly_avg_rating", round_half_up("monthly_avg_rating", 2))
    )
    return conform(out, REVIEW_VELOCITY)


def velocity_analysis(enriched: DataFrame) -> DataFrame:
    """Reviews per product and month with their momentum (see ``velocity_of``)."""
    monthly = enriched.groupBy(
        "parent_asin", "product_title", "store", F.col("review_year_month").alias("year_month")
    ).agg(
        F.count(F.lit(1)).alias("monthly_reviews"),
        F.avg("rating").alias("monthly_avg_rating"),
    )
    return velocity_of(monthly)


def seasonality(velocity: DataFrame) -> DataFrame:
    """Review volume by calendar month across all products and years."""
    return velocity.groupBy(F.month("year_month").alias("review_month")).agg(
        F.sum("monthly_reviews").alias("total_reviews"),
        F.count(F.lit(1)).alias("product_months"),
        F.count_distinct("parent_asin").alias("products"),
    )
