"""Profiling of reviews and metadata (A1, A3-A7, A13-A18, A20-A26, A28, A30,
F4, F5, F7).  Each report is one aggregate job; totals used for shares are
scalar subqueries (distributed aggregates), never driver-side loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions import dates
from revscope.functions.labels import length_band
from revscope.functions.numeric import pct, round_half_up
from revscope.functions.text import head_element, leaf_element, not_contains_ci, text_length

# ---- fixed values ----
COMPLETENESS_OK_PCT = 80
HIGH_DENSITY_MIN_RATINGS = 10000
# ---- end of fixed values ----


def _total(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def record_counts(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Row counts of both inputs (A1), one row."""
    return reviews.agg(F.count(F.lit(1)).alias("review_rows")).select(
        "review_rows", _total(products).alias("product_rows")
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    """Count and share of each rating value (A3); NULL rating is its own row."""
    return df.groupBy("rating").agg(F.count(F.lit(1)).alias("review_count")).withColumn(
        "pct", pct(F.col("review_count"), _total(df))
    )


def overall_rating(df: DataFrame) -> DataFrame:
    """Mean rating (A4)."""
    return df.agg(F.avg("rating").alias("avg_rating"))


def text_stats(df: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Length statistics of review text (A5).  The length is projected once
    (the percentile aggregates are not code-generated and would otherwise
    re-measure every text per aggregate).  ``exact`` percentiles use
    ``percentile_disc``, which aggregates partially as value->count maps
    (bounded by the number of distinct lengths); ``exact=False`` uses the
    sketch-based ``percentile_approx``."""
    lengths = df.select(text_length("text").alias("text_length"))
    n = F.col("text_length")

    def q(p: float):
        if exact:
            return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY text_length)").cast("bigint")
        return F.percentile_approx(n, p, accuracy).cast("bigint")

    return lengths.agg(
        F.count(n).alias("total_reviews"),
        round_half_up(F.avg(n), 2).alias("avg_length"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        round_half_up(F.stddev_samp(n), 2).alias("std_length"),
        q(0.5).alias("median_length"),
        q(0.25).alias("p25_length"),
        q(0.75).alias("p75_length"),
    )


def product_stats(df: DataFrame) -> DataFrame:
    """Per-product review count, mean and sample stddev of rating."""
    return df.groupBy("parent_asin").agg(
        F.count(F.lit(1)).alias("review_count"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        round_half_up(F.stddev_samp("rating"), 2).alias("rating_stddev"),
    )


def product_summary(df: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct products and reviews per product (A7).  ``exact=False`` uses
    the HyperLogLog++ estimate (``approx_count_distinct``)."""
    distinct = F.count_distinct("parent_asin") if exact else F.approx_count_distinct("parent_asin")
    return df.agg(F.count(F.lit(1)).alias("total_rows"), distinct.alias("unique_products")).select(
        "unique_products",
        F.round(F.try_divide("total_rows", "unique_products").cast("decimal(28,10)"), 0)
        .cast("bigint")
        .alias("avg_reviews_per_product"),
    )


def completeness(df: DataFrame, columns: list[str] | None = None, ok_pct: float = COMPLETENESS_OK_PCT) -> DataFrame:
    """Non-null count and share per column (A13) from ONE aggregate pass,
    unpivoted to one row per column.  A requested column that ``df`` lacks
    has a row too, with NULL counts and status ``MISSING``."""
    columns = list(columns or df.columns)
    present = [c if c in df.columns else None for c in columns]
    wide = df.agg(
        F.count(F.lit(1)).alias("__total"), *[(F.count(F.col(c)) if c else F.lit(None).cast("long")).alias(f"__nn_{i}") for i, c in enumerate(present)]
    )
    stacked = wide.select(
        "__total",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"__nn_{i}").alias("nn"))
                    for i, c in enumerate(columns)
                ]
            )
        ).alias("c"),
    )
    share = pct(F.col("c.nn"), F.col("__total"))
    return stacked.select(
        F.col("c.column_name").alias("column_name"),
        F.col("c.position").alias("position"),
        F.col("c.nn").alias("non_null_count"),
        F.col("__total").alias("total_rows"),
        share.alias("completeness_pct"),
        F.when(F.col("c.nn").isNull(), "MISSING")
        .when(pct(F.col("c.nn"), F.col("__total"), None) > ok_pct, "OK")
        .otherwise("LOW")
        .alias("status"),
    )


def text_category_distribution(df: DataFrame) -> DataFrame:
    """Count by length band (A14); NULL text falls to the last band."""
    return df.groupBy(length_band(text_length("text")).alias("text_category")).agg(
        F.count(F.lit(1)).alias("review_count")
    )


def reviews_by_year(df: DataFrame) -> DataFrame:
    """Count by calendar year of the review."""
    return df.groupBy(F.year(dates.review_date("timestamp")).alias("review_year")).agg(
        F.count(F.lit(1)).alias("review_count")
    )


def date_range(df: DataFrame) -> DataFrame:
    """Earliest and latest review time, whole seconds."""
    ts = dates.review_timestamp("timestamp").cast("timestamp_ntz")
    return df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))


def verified_distribution(df: DataFrame) -> DataFrame:
    """Count and share by verified flag."""
    return df.groupBy("verified_purchase").agg(F.count(F.lit(1)).alias("review_count")).withColumn(
        "pct", pct(F.col("review_count"), _total(df))
    )


def helpfulness_stats(df: DataFrame) -> DataFrame:
    """Reviews with votes, mean and max votes."""
    return df.agg(
        F.count_if(F.col("helpful_vote") > 0).alias("reviews_with_votes"),
        round_half_up(F.avg("helpful_vote"), 2).alias("avg_helpful"),
        F.max("helpful_vote").alias("max_helpful"),
    )


#: The counted reports of ``review_profile`` and the column that each is keyed by.
PROFILE_REPORTS = {"rating": "rating", "text_category": "text_category", "review_year": "review_year", "verified": "verified_purchase"}


def review_profile(df: DataFrame) -> DataFrame:
    """Ratings, length bands, years, verified flags, date range and votes
    from one scan and one shuffle: GROUPING SETS expand the narrow projection (no
    text) and are counted map-side, so what is shuffled is a row a group and task.

    One row per report and key: ``report``, ``key`` as text, ``review_count``,
    ``pct`` of all reviews; report ``total`` has the date range and the votes.  The
    single reports are taken from it by ``profile_report``."""
    vote = F.col("helpful_vote")
    narrow = df.select(
        "rating",
        length_band(text_length("text")).alias("text_category"),
        F.year(dates.review_date("timestamp")).alias("review_year"),
        "verified_purchase",
        dates.review_timestamp("timestamp").cast("timestamp_ntz").alias("at"),
        "helpful_vote",
    )
    keys = [F.col(c) for c in PROFILE_REPORTS.values()]
    sets = [*[[k] for k in keys], []]
    counted = narrow.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("__set"),
        F.count(F.lit(1)).alias("review_count"),
        F.min("at").alias("earliest"),
        F.max("at").alias("latest"),
        F.count_if(vote > 0).alias("reviews_with_votes"),
        round_half_up(F.avg(vote), 2).alias("avg_helpful"),
        F.max(vote).alias("max_helpful"),
    )
    # a key that is not in its grouping set has its bit set
    every = (1 << len(keys)) - 1
    report, key = F.lit("total"), F.lit(None).cast("string")
    for i, (name, column) in enumerate(PROFILE_REPORTS.items()):
        own = F.col("__set") == every - (1 << (len(keys) - 1 - i))
        report, key = F.when(own, name).otherwise(report), F.when(own, F.col(column).cast("string")).otherwise(key)
    rows = counted.withColumn("report", report).withColumn("key", key)
    # a row a group: of the counts only, a few hundred rows whatever the input
    total = F.max(F.when(F.col("report") == "total", F.col("review_count"))).over(Window.partitionBy(F.lit(1)))
    stated = [F.when(F.col("report") == "total", F.col(c)).alias(c) for c in ("earliest", "latest", "reviews_with_votes", "avg_helpful", "max_helpful")]
    return rows.select("report", "key", "review_count", pct(F.col("review_count"), total).alias("pct"), *stated)


def profile_report(profile: DataFrame, report: str) -> DataFrame:
    """One report of ``review_profile`` with the columns of its own query."""
    if report == "date_range":
        return profile.filter("report = 'total'").select("earliest", "latest")
    if report == "helpfulness":
        return profile.filter("report = 'total'").select("reviews_with_votes", "avg_helpful", "max_helpful")
    column = PROFILE_REPORTS[report]
    kinds = {"rating": "double", "review_year": "int", "verified_purchase": "boolean"}
    rows = profile.filter(F.col("report") == report).select(F.col("key").cast(kinds.get(column, "string")).alias(column), "review_count", "pct")
    return rows if report in ("rating", "verified") else rows.drop("pct")


def category_distribution(products: DataFrame) -> DataFrame:
    """Products per main category (A20); NULL is a group."""
    return products.groupBy("main_category").agg(F.count(F.lit(1)).alias("product_count"))


def store_distribution(products: DataFrame) -> DataFrame:
    """Products per store (A21); NULL store is kept as a group."""
    return products.groupBy("store").agg(F.count(F.lit(1)).alias("product_count"))


def high_density(products: DataFrame, min_ratings: int = HIGH_DENSITY_MIN_RATINGS) -> DataFrame:
    """Products with at least ``min_ratings`` ratings."""
    return products.filter(F.col("rating_number") >= min_ratings)


def high_density_summary(products: DataFrame, min_ratings: int = HIGH_DENSITY_MIN_RATINGS) -> DataFrame:
    """Count and rating total of the high-density products."""
    return high_density(products, min_ratings).agg(
        F.count(F.lit(1)).alias("products"), F.sum("rating_number").cast("bigint").alias("total_ratings")
    )


def exclude_store(products: DataFrame, needle: str) -> DataFrame:
    """Drop products whose store contains ``needle`` in any case; NULL stores stay."""
    return products.filter(not_contains_ci("store", needle))


def priced_products(products: DataFrame) -> DataFrame:
    """Products that state a price."""
    return products.filter(F.col("price").isNotNull()).select("parent_asin", "price")


def head_category_counts(products: DataFrame) -> DataFrame:
    """Products by first category element, 'Unknown' when none."""
    return products.groupBy(head_element("categories").alias("category")).agg(F.count(F.lit(1)).alias("product_count"))


def leaf_category_counts(products: DataFrame) -> DataFrame:
    """Products by last (most specific) category element."""
    return products.groupBy(leaf_element("categories").alias("category")).agg(F.count(F.lit(1)).alias("product_count"))


def store_counts(products: DataFrame) -> DataFrame:
    """Products per store with NULL stores dropped."""
    return (
        products.filter(F.col("store").isNotNull())
        .groupBy("store")
        .agg(F.count(F.lit(1)).alias("product_count"))
    )


def metadata_stats(products: DataFrame) -> DataFrame:
    """Rated products, mean and max of rating_number."""
    return products.agg(
        F.count("rating_number").alias("rated_products"),
        round_half_up(F.avg("rating_number"), 1).alias("avg_rating_number"),
        F.max("rating_number").alias("max_rating_number"),
    )


def brand_performance(enriched: DataFrame) -> DataFrame:
    """Store totals with unrounded satisfaction."""
    return (
        enriched.groupBy("store")
        .agg(
            F.count(F.lit(1)).alias("total_reviews"),
            F.avg("rating").alias("avg_rating"),
            F.count_if(F.col("rating") >= 4).alias("positive_reviews"),
            F.count_if(F.col("rating") <= 2).alias("negative_reviews"),
        )
        .withColumn("satisfaction_rate", pct("positive_reviews", "total_reviews", None))
    )


def brand_comparison(enriched: DataFrame, category_like: str) -> DataFrame:
    """Store comparison within categories containing ``category_like``."""
    return (
        enriched.filter(F.col("main_category").contains(category_like))
        .groupBy("store")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.avg("rating").alias("avg_rating"),
            F.count_if(F.col("sentiment") == "Positive").alias("_pos"),
        )
        .select(
            "store",
            "reviews",
            round_half_up("avg_rating", 2).alias("avg_rating"),
            pct("_pos", "reviews").alias("satisfaction_rate"),
        )
    )


def exploration_summary(df: DataFrame) -> DataFrame:
    """One row: rows, exact distinct products, mean rating, date range."""
    ts = dates.review_timestamp("timestamp").cast("timestamp_ntz")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("parent_asin").alias("unique_products"),
        F.avg("rating").alias("avg_rating"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
    )


def verified_comparison(enriched: DataFrame) -> DataFrame:
    """Verified vs. unverified reviews: rating, length, votes."""
    return enriched.groupBy("verified_purchase").agg(
        F.count(F.lit(1)).alias("review_count"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        round_half_up(F.avg("review_length"), 2).alias("avg_review_length"),
        round_half_up(F.avg("helpful_vote"), 2).alias("avg_helpful_votes"),
    )
