"""Mergeable partial states of the feature tables (A8, A10, A12) and of sketches.

A state row holds sums, never averages: counts, exact decimal sums of ratings
and of their squares, minima and maxima.  States of two sets of reviews are
merged by adding them up, so a new day costs its own reviews and the states,
not all reviews again, and the features of the merged states are those of all
reviews.  Ratings are summed as decimals, so neither the order of merging nor
their number shows in an average or a standard deviation.

Distinct counts merge too: exactly, by bitmaps over dense reviewer ids
(``reviewers``), and within a stated error, by sketches by month.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revscope.operators.competitive import PRODUCT_KEYS, profile_of
from revscope.operators.sentiment import trends_of
from revscope.operators.velocity import velocity_of

STATE_KEYS = (*PRODUCT_KEYS, "year_month")
_ADDED = (
    "reviews", "ratings", "rating_sum", "rating_squares", "positive", "negative", "neutral", "lengths", "length_sum",
    "detailed", "verified", "votes", "vote_sum",
)

#: HyperLogLog registers (2^k) and KLL's k: their relative standard errors are about 1.04 / sqrt(2^k) and, in rank, 1.65 / k.
HLL_K, KLL_K = 14, 400
#: What the sketches are held to: distinct counts relatively, quantiles in rank.
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.015


def _rating() -> Column:
    return F.col("rating").cast("decimal(10,4)")


def review_states(enriched: DataFrame, *by: str) -> DataFrame:
    """One state row for each product (all its attributes) and month of ``enriched`` reviews.

    The aggregate combines map-side: a product of any size ships a row a task.
    ``by``: columns that tell batches apart; the states of all are then made in one pass."""
    whole = lambda c: F.sum(c).cast("long")
    return enriched.groupBy(*by, *PRODUCT_KEYS, F.col("review_year_month").alias("year_month")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count("rating").alias("ratings"),
        F.sum(_rating()).cast("decimal(38,4)").alias("rating_sum"),
        F.sum((_rating() * _rating()).cast("decimal(20,8)")).cast("decimal(38,8)").alias("rating_squares"),
        F.count_if(F.col("sentiment") == "Positive").alias("positive"),
        F.count_if(F.col("sentiment") == "Negative").alias("negative"),
        F.count_if(F.col("sentiment") == "Neutral").alias("neutral"),
        F.count("review_length").alias("lengths"),
        whole("review_length").alias("length_sum"),
        whole("is_detailed_review").alias("detailed"),
        F.count_if(F.col("verified_purchase")).alias("verified"),
        F.count("helpful_vote").alias("votes"),
        whole(F.col("helpful_vote").cast("long")).alias("vote_sum"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
    )


def _sums(*names: str) -> list[Column]:
    kinds = {"rating_sum": "decimal(38,4)", "rating_squares": "decimal(38,8)"}
    return [F.sum(n).cast(kinds.get(n, "long")).alias(n) for n in names]


def merge_states(*states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The state of all reviews whose states are given: same schema, one row a key.
    ``by``: further columns that stay, as the bucket a product's reviews were dealt by."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy(*by, *STATE_KEYS).agg(*_sums(*_ADDED), F.min("first_review_date").alias("first_review_date"), F.max("last_review_date").alias("last_review_date"))


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(n))


def _deviation() -> Column:
    """Sample standard deviation from exact sums; NULL for fewer than two ratings."""
    n, total, squares = F.col("ratings"), F.col("rating_sum").cast("double"), F.col("rating_squares").cast("double")
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


def trends_from_states(states: DataFrame) -> DataFrame:
    """``sentiment_trends`` of the reviews that ``states`` hold."""
    monthly = states.groupBy("store", "year_month").agg(*_sums("reviews", "ratings", "rating_sum", "positive", "negative", "neutral"))
    return trends_of(
        monthly.select(
            "store", "year_month", F.col("reviews").alias("review_count"), _mean("rating_sum", "ratings").alias("avg_rating"),
            F.col("positive").alias("positive_count"), F.col("negative").alias("negative_count"), F.col("neutral").alias("neutral_count"),
        )
    )


def velocity_from_states(states: DataFrame) -> DataFrame:
    """``velocity_analysis`` of the reviews that ``states`` hold."""
    monthly = states.groupBy("parent_asin", "product_title", "store", "year_month").agg(*_sums("reviews", "ratings", "rating_sum"))
    return velocity_of(monthly.withColumnRenamed("reviews", "monthly_reviews").withColumn("monthly_avg_rating", _mean("rating_sum", "ratings")))


def competitive_from_states(states: DataFrame, unique: DataFrame) -> DataFrame:
    """``competitive_analysis`` of the reviews that ``states`` hold; ``unique``:
    (product keys, unique_reviewers), as from ``reviewers.unique_reviewers``."""
    total = states.groupBy(*PRODUCT_KEYS).agg(*_sums(*_ADDED), F.min("first_review_date").alias("first_review_date"), F.max("last_review_date").alias("last_review_date"))
    counted = unique.select(*[F.col(k).alias(f"__{k}") for k in PRODUCT_KEYS], "unique_reviewers")
    same = reduce(lambda a, b: a & b, [total[k].eqNullSafe(counted[f"__{k}"]) for k in PRODUCT_KEYS])
    rows = total.join(counted, same, "left")
    return profile_of(
        rows.select(
            *PRODUCT_KEYS,
            F.col("reviews").alias("total_reviews"),
            F.coalesce("unique_reviewers", F.lit(0).cast("long")).alias("unique_reviewers"),
            _mean("rating_sum", "ratings").alias("avg_rating"),
            _deviation().alias("rating_stddev"),
            F.col("positive").alias("positive_reviews"),
            F.col("negative").alias("negative_reviews"),
            F.col("neutral").alias("neutral_reviews"),
            _mean("length_sum", "lengths").alias("avg_review_length"),
            F.col("detailed").alias("detailed_reviews"),
            F.col("verified").alias("verified_purchases"),
            _mean("vote_sum", "votes").alias("avg_helpful_votes"),
            "first_review_date",
            "last_review_date",
        )
    )


def sketch_states(reviews: DataFrame, *by: str) -> DataFrame:
    """One row a month: counts, HLL sketches of products and reviewers, a KLL sketch of text lengths.

    ``reviews`` needs parent_asin, user_id, review_year_month and review_length.
    ``by``: columns that tell batches apart, as in ``review_states``."""
    return reviews.groupBy(*by, F.col("review_year_month").alias("year_month")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count("review_length").alias("lengths"),
        F.sum("review_length").cast("long").alias("length_sum"),
        F.min("review_length").alias("length_min"),
        F.max("review_length").alias("length_max"),
        F.hll_sketch_agg("parent_asin", F.lit(HLL_K)).alias("products"),
        F.hll_sketch_agg("user_id", F.lit(HLL_K)).alias("reviewers"),
        F.kll_sketch_agg_bigint(F.col("review_length").cast("long"), F.lit(KLL_K)).alias("length_sketch"),
    )


def merge_sketches(*states: DataFrame) -> DataFrame:
    """The sketches of all reviews whose sketches are given, by month."""
    return _merged_sketches(reduce(DataFrame.unionByName, states), "year_month")


def _merged_sketches(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *_sums("reviews", "lengths", "length_sum"),
        F.min("length_min").alias("length_min"),
        F.max("length_max").alias("length_max"),
        F.hll_union_agg("products").alias("products"),
        F.hll_union_agg("reviewers").alias("reviewers"),
        F.kll_merge_agg_bigint("length_sketch", F.lit(KLL_K)).alias("length_sketch"),
    )


def summary_from_sketches(states: DataFrame, months: Column | None = None) -> DataFrame:
    """Counts, distinct products and reviewers (within ``DISTINCT_ERROR``) and text
    length quartiles (ranks within ``RANK_ERROR``) of the months chosen, from
    stored sketches alone: no review is read."""
    rows = states if months is None else states.filter(months)
    quartile = lambda p: F.kll_sketch_get_quantile_bigint("length_sketch", F.lit(p))
    return _merged_sketches(rows).select(
        F.col("reviews").alias("total_reviews"),
        F.hll_sketch_estimate("products").alias("unique_products"),
        F.hll_sketch_estimate("reviewers").alias("unique_reviewers"),
        _mean("length_sum", "lengths").alias("avg_length"),
        F.col("length_min").alias("min_length"),
        F.col("length_max").alias("max_length"),
        quartile(0.25).alias("p25_length"),
        quartile(0.5).alias("median_length"),
        quartile(0.75).alias("p75_length"),
    )


def sketch_accuracy(reviews: DataFrame, states: DataFrame) -> DataFrame:
    """The stored sketches against the reviews: metric, exact value, and whether the
    sketches are within their stated error.  A quantile's rank is measured, not its value."""
    # one subquery, so that Spark builds the sketches once however often they are asked
    summary = summary_from_sketches(states).select(F.struct("*").alias("s")).scalar()
    quartiles = {"p25_length": 0.25, "median_length": 0.5, "p75_length": 0.75}
    length = F.col("review_length")
    exact = reviews.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_distinct("parent_asin").alias("products"),
        F.count_distinct("user_id").alias("reviewers"),
        F.count(length).alias("lengths"),
        *[F.count_if(length < summary[c]).alias(f"{c}_below") for c in quartiles],
        *[F.count_if(length <= summary[c]).alias(f"{c}_upto") for c in quartiles],
    )
    near = lambda found, c: F.abs(summary[found] - F.col(c)) <= F.lit(DISTINCT_ERROR) * F.col(c)
    metrics = [
        ("reviews", F.col("reviews"), summary["total_reviews"] == F.col("reviews")),
        ("products", F.col("products"), near("unique_products", "products")),
        ("reviewers", F.col("reviewers"), near("unique_reviewers", "reviewers")),
        *[
            (c, F.col("lengths"), (F.col(f"{c}_below") <= (p + RANK_ERROR) * F.col("lengths")) & (F.col(f"{c}_upto") >= (p - RANK_ERROR) * F.col("lengths")))
            for c, p in quartiles.items()
        ],
    ]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("exact"), w.alias("within")) for m, v, w in metrics])
    return exact.select(F.explode(rows).alias("r")).select("r.*")
