"""Success scoring over the competitive profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.functions.labels import SUCCESS_SATISFACTION, SUCCESS_VOLUME, success_category
from revscope.functions.numeric import round_half_up
from revscope.schemas import SUCCESS_PREDICTION, conform

# ---- fixed values: score weights and the stddev penalty of the original job ----
SATISFACTION_WEIGHT = 0.4
CONSISTENCY_WEIGHT = 0.3
TRUST_WEIGHT = 0.3
STDDEV_PENALTY = 20
# ---- end of fixed values ----


def success_prediction(
    competitive: DataFrame,
    satisfaction_bounds: tuple = SUCCESS_SATISFACTION,
    volume_bounds: tuple = SUCCESS_VOLUME,
) -> DataFrame:
    """Row-wise projection of the (already 2-dp rounded) competitive metrics.
    A product with one rating has a NULL stddev and therefore a NULL score,
    but still gets a category.  Narrow projection: no shuffle."""
    c = F.col
    score = (
        c("satisfaction_rate") * SATISFACTION_WEIGHT
        + (100 - c("rating_stddev") * STDDEV_PENALTY) * CONSISTENCY_WEIGHT
        + c("verified_rate") * TRUST_WEIGHT
    )
    out = competitive.select(
        "parent_asin",
        "product_title",
        "store",
        round_half_up(score).alias("success_score"),
        success_category("satisfaction_rate", "total_reviews", satisfaction_bounds, volume_bounds).alias(
            "success_category"
        ),
        "satisfaction_rate",
        "rating_stddev",
        "verified_rate",
        round_half_up(c("total_reviews") / (c("review_span_days") + 1)).alias("review_velocity"),
        round_half_up(c("avg_review_length") / 100 * (c("avg_helpful_votes") + 1)).alias("engagement_score"),
    )
    return conform(out, SUCCESS_PREDICTION)


def success_distribution(prediction: DataFrame) -> DataFrame:
    """Products per success category."""
    return prediction.groupBy("success_category").agg(F.count(F.lit(1)).alias("product_count"))
