"""Enrichment: reviews joined to their product metadata plus derived columns
(E2, J1, J3, J6, F1, F2, A19, A29, X1-X11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.functions import dates, labels
from revscope.functions.numeric import pct
from revscope.functions.text import text_length


def distinct_products(reviews: DataFrame) -> DataFrame:
    """Distinct reviewed product ids (A29).  Map-side partial aggregation means
    a product holding a third of all reviews still ships one key per task."""
    return reviews.select("parent_asin").distinct()


def sampled_products(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Metadata restricted to products that have reviews (J1): a left-semi join
    against the de-duplicated key set, so metadata rows are never multiplied."""
    return products.join(distinct_products(reviews), on="parent_asin", how="left_semi")


def unmatched_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviewed products lacking metadata."""
    return distinct_products(reviews).join(products.select("parent_asin"), on="parent_asin", how="left_anti")


def product_dim(products: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Product columns for the review join, ``title`` renamed to
    ``product_title`` so it cannot collide with the review title (F1)."""
    cols = [
        F.col("parent_asin"),
        F.col("title").alias("product_title"),
        F.col("main_category"),
        F.col("store"),
        F.col("price"),
        F.col("features"),
        F.col("description"),
    ]
    cols += [F.col(src).alias(dst) for src, dst in (extra or {}).items()]
    return products.select(*cols)


# ---- skew handling parameters ----
ROWS_PER_SALT = 2_000_000    # target review rows per salted join partition of a hot key
MAX_HOT_KEYS = 100_000       # hot keys named at most (the largest); any other key has under 1/100,000 of all rows
NULL_SALTS = 1_024           # buckets of the reviews without product id, which match nothing
SALT_COLUMNS = ("user_id", "timestamp")
SALT = "_salt"
# ----


def review_key_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per product id (NULL ids included as one group).  Partial
    aggregation map-side: a hot id costs one row per task."""
    return reviews.groupBy("parent_asin").agg(F.count(F.lit(1)).alias("review_rows"))


def hot_products(counts: DataFrame, rows_per_salt: int = ROWS_PER_SALT, most: int = MAX_HOT_KEYS) -> DataFrame:
    """Product ids with more than ``rows_per_salt`` reviews and the number of
    salt buckets each needs.  The list is cut to the ``most`` largest, which
    bounds its broadcast; a key beyond them holds less than 1 / ``most`` of
    all reviews, so it is no hot key however many rows there are."""
    return (
        counts.filter(F.col("parent_asin").isNotNull() & (F.col("review_rows") > rows_per_salt))
        .orderBy(F.desc("review_rows"), "parent_asin")
        .limit(most)
        .select("parent_asin", F.ceil(F.col("review_rows") / rows_per_salt).cast("int").alias("salts"))
    )


def attach_products(reviews: DataFrame, dim: DataFrame, hot: DataFrame | None = None, keep_salt: bool = False) -> DataFrame:
    """Left outer join (J3): a review without metadata survives with NULL
    product columns.  Spark picks broadcast vs. shuffle from the dimension's
    measured size (AQE).  When ``hot`` keys are given (one row per id), their
    reviews are spread over ``salts`` buckets and only their dimension rows
    are replicated once per bucket; the join runs on (key, bucket), so a
    product holding a third of all reviews is split over many tasks.  Reviews
    without product id, which match nothing, are spread too.

    A review's bucket is a hash of who wrote it and when: the same on every
    attempt, and it reads no column that the query does not need otherwise
    but these two.  Every review still meets exactly its product's dimension
    rows, so the result does not depend on the bucket.

    ``keep_salt``: the bucket stays, as ``SALT``, and the reviews are dealt by product
    and bucket in any case; what is then grouped by these two and more is not shuffled
    again."""
    if hot is None:
        joined = reviews.join(dim, on="parent_asin", how="left")
    else:
        h = F.broadcast(hot.select("parent_asin", "salts"))
        row_hash = F.xxhash64(*[F.col(c) for c in SALT_COLUMNS if c in reviews.columns] or [F.col("parent_asin")])
        salts = F.when(F.col("parent_asin").isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("salts", F.lit(1)))
        salted = (
            reviews.join(h, on="parent_asin", how="left")
            .withColumn(SALT, F.pmod(row_hash, salts).cast("int"))
            .drop("salts")
        )
        if keep_salt:
            salted = salted.repartition("parent_asin", SALT)
        replicated = (
            dim.join(h, on="parent_asin", how="left")
            .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
            .drop("salts")
        )
        joined = salted.join(replicated, on=["parent_asin", SALT], how="left")
        joined = joined if keep_salt else joined.drop(SALT)
    return joined.withColumnRenamed("title", "review_title")


def add_review_columns(df: DataFrame, detailed_min_length: int = labels.DETAILED_MIN_LENGTH) -> DataFrame:
    """Columns that depend on the review alone: date, month, sentiment, text
    length and the detailed-review flag (X1-X4, X8, X11)."""
    return add_narrow_columns(df.withColumn("review_length", text_length("text")), detailed_min_length)


def add_narrow_columns(df: DataFrame, detailed_min_length: int = labels.DETAILED_MIN_LENGTH) -> DataFrame:
    """The columns of ``add_review_columns`` beside the text length, which is there already."""
    return (
        df.withColumn("review_date", dates.review_date("timestamp"))
        .withColumn("review_year_month", dates.year_month("review_date"))
        .withColumn("sentiment", labels.sentiment("rating"))
        .withColumn("is_detailed_review", labels.is_detailed("review_length", detailed_min_length))
    )


def add_product_columns(dim: DataFrame) -> DataFrame:
    """Columns that depend on the product alone: parsed price and tier."""
    return dim.withColumn("price_numeric", labels.price_numeric("price")).withColumn(
        "price_tier", labels.price_tier("price_numeric")
    )


def measured(reviews: DataFrame) -> DataFrame:
    """``reviews`` with the length of their text (X8); those that have it stay as they are."""
    return reviews if "review_length" in reviews.columns else reviews.withColumn("review_length", text_length("text"))


def prepare(
    reviews: DataFrame,
    products: DataFrame,
    product_extra: dict[str, str] | None = None,
    rows_per_salt: int | None = ROWS_PER_SALT,
    keep_salt: bool = False,
) -> DataFrame:
    """Reviews enriched with product metadata.

    * The dimension is restricted to reviewed products (J1) with a semi join
      against the per-product review counts, which keeps it small enough
      for AQE to broadcast whenever the reviewed set is small.  The same
      counts name the hot products whose join is salted (see
      ``attach_products``).
    * The text is measured before the join (so the review text can be
      dropped before it when no later step needs it); what follows from
      narrow review columns is derived after it, so the join's shuffle does
      not carry it.  The price is parsed once per product on the dimension
      side instead of once per review; a review without metadata gets the
      'Unknown' tier, exactly as the NULL-price rule gives.
    * Metadata is not de-duplicated: a duplicated ``parent_asin`` multiplies
      its reviews, as in the original job; ``quality.duplicate_products``
      reports such ids.
    * ``rows_per_salt=None`` joins without salting.
    * ``reviews`` may be ``measured`` already, and staged without their text.
    * ``keep_salt``: see ``attach_products``."""
    return add_narrow_columns(join_products(measured(reviews), products, product_extra, rows_per_salt, keep_salt))


def add_products(keyed: DataFrame, products: DataFrame) -> DataFrame:
    """Product columns for rows that are few a product (J3): the join of ``prepare`` for
    aggregates of reviews, which have no hot key and need no count of their own."""
    enriched = attach_products(keyed, add_product_columns(product_dim(products)))
    return enriched.withColumn("price_tier", F.coalesce(F.col("price_tier"), F.lit(labels.PRICE_TIERS[0])))


def join_products(
    reviews: DataFrame,
    products: DataFrame,
    product_extra: dict[str, str] | None = None,
    rows_per_salt: int | None = ROWS_PER_SALT,
    keep_salt: bool = False,
) -> DataFrame:
    """The join of ``prepare``, for reviews whose own columns are derived already."""
    counts = review_key_counts(reviews)
    # `review_rows > 0` always holds; referencing the count keeps this use of
    # the per-product counts identical to the hot-key one, so Spark computes
    # the counts shuffle once and reuses it for both
    reviewed = counts.filter(F.col("review_rows") > 0).select("parent_asin")
    sampled = products.join(reviewed, on="parent_asin", how="left_semi")
    dim = add_product_columns(product_dim(sampled, product_extra))
    hot = None if rows_per_salt is None else hot_products(counts, rows_per_salt)
    enriched = attach_products(reviews, dim, hot, keep_salt)
    return enriched.withColumn("price_tier", F.coalesce(F.col("price_tier"), F.lit(labels.PRICE_TIERS[0])))


def match_rate(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """How many reviewed products have metadata (A19): one row.  ``matched``
    counts metadata rows of reviewed products (duplicates included)."""
    n_matched = sampled_products(products, reviews).select(F.count(F.lit(1))).scalar()
    sampled = distinct_products(reviews).agg(F.count(F.lit(1)).alias("sampled_products"))
    return sampled.select(
        "sampled_products",
        n_matched.alias("matched_products"),
        pct(n_matched, "sampled_products", 1).alias("match_rate_pct"),
        (F.col("sampled_products") - n_matched).alias("missing_products"),
    )
