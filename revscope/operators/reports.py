"""Ranked reports over the feature tables (K4-K13).  Every ordering ends in
a unique key so results repeat; ``orderBy().limit(k)`` plans as a per-task
top-k followed by a k-row merge (TakeOrderedAndProject)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from revscope.functions.text import shorten


def store_recent_trend(trends: DataFrame, store: str, k: int = 12) -> DataFrame:
    """Latest k months of one store (K4)."""
    return (
        trends.filter(F.col("store") == store)
        .orderBy(F.desc("year_month"))
        .limit(k)
        .select("year_month", "review_count", "avg_rating", "positive_rate", "rating_change", "trend_direction")
    )


def top_negative_products(theme: DataFrame, k: int = 10) -> DataFrame:
    """Products with the most negative reviews (K5)."""
    return (
        theme.filter(F.col("sentiment") == "Negative")
        .orderBy(F.desc("review_count"), F.asc("parent_asin"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store"))
        .limit(k)
        .select("parent_asin", "product_title", "store", "review_count", "avg_rating")
    )


def top_satisfaction(competitive: DataFrame, min_reviews: int | None = 1000, k: int = 10) -> DataFrame:
    """Highest satisfaction among products with at least ``min_reviews`` (K6, Q3)."""
    df = competitive if min_reviews is None else competitive.filter(F.col("total_reviews") >= min_reviews)
    return (
        df.orderBy(
            F.desc_nulls_last("satisfaction_rate"), F.asc("parent_asin"), F.asc_nulls_first("product_title"),
            F.asc_nulls_first("store"), F.asc_nulls_first("main_category"), F.asc_nulls_first("price_tier"),
        )
        .limit(k)
        .select("parent_asin", "product_title", "store", "total_reviews", "avg_rating", "satisfaction_rate", "negative_rate")
    )


def top_success(prediction: DataFrame, k: int = 5) -> DataFrame:
    """Best success scores (K7); NULL scores last."""
    return (
        prediction.orderBy(
            F.desc_nulls_last("success_score"), F.asc("parent_asin"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store")
        )
        .limit(k)
        .select("parent_asin", "product_title", "store", "success_score", "satisfaction_rate", "review_velocity", "success_category")
    )


def bottom_success(prediction: DataFrame, k: int = 5) -> DataFrame:
    """Lowest success scores (K7).  An ascending sort puts NULL scores (one
    rating, no stddev) first, as the published report does."""
    return (
        prediction.orderBy(
            F.asc_nulls_first("success_score"), F.asc("parent_asin"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store")
        )
        .limit(k)
        .select("parent_asin", "product_title", "store", "success_score", "satisfaction_rate", "success_category")
    )


def top_by(df: DataFrame, metric: str, key: str, k: int) -> DataFrame:
    """Generic top-k by a count column with the group key as tiebreak (K8)."""
    return df.orderBy(F.desc(metric), F.asc_nulls_first(key)).limit(k)


def top_brands(performance: DataFrame, k: int = 15) -> DataFrame:
    """Stores with the most reviews (K8), over ``brand_performance``."""
    return top_by(performance, "total_reviews", "store", k)


def top_categories(category_counts: DataFrame, k: int = 10) -> DataFrame:
    """Largest main categories (K8), over ``category_distribution``."""
    return top_by(category_counts, "product_count", "main_category", k)


def top_stores(store_counts: DataFrame, k: int = 15) -> DataFrame:
    """Stores with the most products (K8), over ``store_distribution``."""
    return top_by(store_counts, "product_count", "store", k)


def surging(velocity: DataFrame, k: int = 10) -> DataFrame:
    """Fastest-growing product months (K9)."""
    return (
        velocity.filter(F.col("momentum") == "Surging")
        .orderBy(F.desc("velocity_change_pct"), F.asc("parent_asin"), F.asc("year_month"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store"))
        .limit(k)
        .select("parent_asin", "product_title", "store", "year_month", "monthly_reviews", "velocity_change_pct")
    )


def declining(velocity: DataFrame, k: int = 10, skip_first_month: bool = False) -> DataFrame:
    """Declining or collapsing product months, steepest first (K10).  A
    product's first month has a NULL percentage, counts as Collapsing and
    sorts first (ascending, NULLs first) unless ``skip_first_month``."""
    df = velocity.filter(F.col("momentum").isin("Declining", "Collapsing"))
    if skip_first_month:
        df = df.filter(F.col("velocity_change_pct").isNotNull())
    return (
        df.orderBy(F.asc_nulls_first("velocity_change_pct"), F.asc("parent_asin"), F.asc("year_month"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store"))
        .limit(k)
        .select("parent_asin", "product_title", "store", "year_month", "monthly_reviews", "velocity_change_pct", "momentum")
    )


def latest_trends(trends: DataFrame, k: int = 10) -> DataFrame:
    """Most recent store-months."""
    return (
        trends.orderBy(F.desc("year_month"), F.asc_nulls_first("store"))
        .limit(k)
        .select("store", "year_month", "review_count", "avg_rating", "trend_direction")
    )


def latest_momentum(velocity: DataFrame, k: int = 10, momenta: tuple = ("Surging", "Declining")) -> DataFrame:
    """Most recent product months with the given momentum."""
    return (
        velocity.filter(F.col("momentum").isin(*momenta))
        .orderBy(F.desc("year_month"), F.asc("parent_asin"), F.asc_nulls_first("product_title"), F.asc_nulls_first("store"))
        .limit(k)
        .select("parent_asin", "product_title", "year_month", "monthly_reviews", "momentum")
    )


def peek(df: DataFrame, n: int = 5, width: int = 100, order_by: list[str] | None = None) -> DataFrame:
    """First rows for display (K12), in ``order_by`` order where given: long
    strings cut to ``width`` characters, arrays and maps shown as 'N items'."""
    if order_by:
        df = df.orderBy(*[F.asc_nulls_first(c) for c in order_by])
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, StringType):
            c = shorten(c, width)
        elif isinstance(field.dataType, (ArrayType, MapType)):
            c = F.concat(F.coalesce(F.size(c), F.lit(0)).cast("string"), F.lit(" items"))
        cols.append(c.alias(field.name))
    return df.limit(n).select(*cols)


def random_sample(df: DataFrame, fraction: float, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """Random sample without replacement (K13) by a threshold on a hash of each row.

    A row's number is made of the first 32 bits of the MD5 of ``seed`` and of
    ``keys`` (all columns by default) as text; it is sampled if that is below
    ``fraction``.  So the same rows are sampled however they lie in files and
    tasks, on any engine; rows of equal keys share their fate."""
    return df.filter(_row_number(df, seed, keys) < F.lit(int(fraction * 2**32)))


def random_per_group(df: DataFrame, group: str, n: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """``n`` random rows of each ``group`` (all, if fewer): those with the least
    hashes, equal ones by their values.  Cut on the map side, whatever the group's size."""
    keys = list(keys or df.columns)
    order = Window.partitionBy(group).orderBy("__hash", *keys)
    ranked = df.withColumn("__hash", _row_number(df, seed, keys)).withColumn("__rn", F.row_number().over(order))
    return ranked.filter(F.col("__rn") <= n).drop("__hash", "__rn")


def _row_number(df: DataFrame, seed: int, keys: list[str] | None):
    """32 bits of an MD5 over ``keys``; NULLs and the borders of values are told apart."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in keys or df.columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("long")
