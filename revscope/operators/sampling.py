"""Dense-sample selection (A2, J2, J4, J5, K1-K3, W3): count reviews per
product, pick the top products above a volume floor and extract their reviews.
Two distributed passes over the reviews instead of two single-machine scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions.text import leaf_element

# ---- fixed values (defaults of the original sampling step) ----
TARGET_MIN_REVIEWS = 20000
TARGET_COUNT = 50
TOP_PRODUCTS = 20
TOP_REVIEWED = 10
# ---- end of fixed values ----


def review_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per product; NULL or empty ids are skipped (A2)."""
    return (
        reviews.filter(F.col("parent_asin").isNotNull() & (F.col("parent_asin") != ""))
        .groupBy("parent_asin")
        .agg(F.count(F.lit(1)).alias("actual_reviews"))
    )


def products_with_counts(products: DataFrame, counts: DataFrame) -> DataFrame:
    """Metadata joined to review counts (J2, inner equi join)."""
    return products.join(counts, on="parent_asin", how="inner")


def top_products(counts: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Products with the most reviews (K2); id breaks ties."""
    return counts.orderBy(F.desc("actual_reviews"), F.asc("parent_asin")).limit(k)


def label_top_products(counts: DataFrame, products: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Top-k products labelled with title and store, falling back to the id
    when metadata is missing (J5).  The lookup side is cut to the k ids first
    (semi join against the broadcast k-row list), so the label aggregation
    only touches k products."""
    top = top_products(counts, k)
    labels = (
        products.join(F.broadcast(top.select("parent_asin")), on="parent_asin", how="left_semi")
        .groupBy("parent_asin")
        .agg(F.min(F.struct(F.col("title").isNull().alias("untitled"), "title", "store")).alias("m"))
        .select("parent_asin", "m.title", "m.store")
    )
    return top.join(labels, on="parent_asin", how="left").select(
        "parent_asin",
        "actual_reviews",
        F.coalesce(F.col("title"), F.concat(F.lit("ASIN: "), F.col("parent_asin"))).alias("label"),
        "store",
    )


def target_products(
    products: DataFrame, counts: DataFrame, min_reviews: int = TARGET_MIN_REVIEWS, k: int = TARGET_COUNT
) -> DataFrame:
    """The k products with the most reviews among those with at least
    ``min_reviews`` (K3)."""
    pool = products_with_counts(products, counts).filter(F.col("actual_reviews") >= min_reviews)
    return pool.orderBy(F.desc("actual_reviews"), F.asc("parent_asin")).limit(k).select(
        "parent_asin", "title", "store", "actual_reviews"
    )


def target_summary(
    products: DataFrame, counts: DataFrame, min_reviews: int = TARGET_MIN_REVIEWS, k: int = TARGET_COUNT
) -> DataFrame:
    """Size and review total of the pool and of the pick (K3), one row."""
    pool = products_with_counts(products, counts).filter(F.col("actual_reviews") >= min_reviews)
    pick = target_products(products, counts, min_reviews, k)
    return pool.agg(
        F.count(F.lit(1)).alias("pool_products"), F.sum("actual_reviews").cast("bigint").alias("pool_reviews")
    ).select(
        "pool_products",
        "pool_reviews",
        pick.select(F.count(F.lit(1))).scalar().alias("picked_products"),
        pick.select(F.sum("actual_reviews").cast("bigint")).scalar().alias("picked_reviews"),
    )


def extract_sample(reviews: DataFrame, targets: DataFrame) -> DataFrame:
    """Reviews of the target products (J4).  A list of targets that Spark
    measures as small is broadcast and the reviews stream past it; nothing is
    assumed of a longer one."""
    return reviews.join(targets.select("parent_asin").distinct(), on="parent_asin", how="left_semi")


def sample_scan_report(reviews: DataFrame, targets: DataFrame) -> DataFrame:
    """Scanned and kept review rows of the extraction (J4), one pass."""
    keys = targets.select("parent_asin").distinct().withColumn("_hit", F.lit(1))
    tagged = reviews.select("parent_asin").join(keys, on="parent_asin", how="left")
    return tagged.agg(
        F.count(F.lit(1)).alias("scanned_reviews"), F.count("_hit").alias("extracted_reviews")
    )


def top_reviewed(products: DataFrame, k: int = TOP_REVIEWED) -> DataFrame:
    """Products with the most ratings (K1); products without a count are skipped."""
    return (
        products.filter(F.col("rating_number").isNotNull())
        .orderBy(F.desc("rating_number"), F.asc("parent_asin"))
        .limit(k)
        .select("parent_asin", "title", "rating_number", "average_rating", "store")
    )


def top_per_category(products: DataFrame, k_categories: int = 5, k: int = 5) -> DataFrame:
    """Top-k products (by ratings) inside each of the k largest leaf categories
    (W3).  The category list is cut to ``k_categories`` rows, so broadcasting
    it is size-bounded; ``row_number() <= k`` is cut per task before the
    shuffle (WindowGroupLimit), so a huge category never lands whole in one task."""
    with_cat = products.withColumn("category", leaf_element("categories"))
    top_cats = (
        with_cat.groupBy("category")
        .agg(F.count(F.lit(1)).alias("category_products"))
        .orderBy(F.desc("category_products"), F.asc("category"))
        .limit(k_categories)
    )
    ranked = (
        with_cat.join(F.broadcast(top_cats), on="category", how="inner")
        .withColumn(
            "rank_in_category",
            F.row_number().over(
                Window.partitionBy("category").orderBy(
                    F.desc_nulls_last("rating_number"), F.asc("parent_asin")
                )
            ),
        )
        .filter(F.col("rank_in_category") <= k)
    )
    return ranked.select(
        "category", "category_products", "rank_in_category", "parent_asin", "title", "rating_number", "store"
    )
