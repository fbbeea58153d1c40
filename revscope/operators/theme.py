"""Theme preparation and review-text samples."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.functions.numeric import round_half_up
from revscope.schemas import THEME_PREP, conform

# ---- fixed values ----
THEME_MIN_REVIEWS = 10
SAMPLE_SEPARATOR = "|"
# ---- end of fixed values ----

#: Characters of a text that rank it before it is fetched.
HEAD_CHARS = 32
#: What names a text before it is fetched.
TEXT_KEYS = ("text_head", "text_digest")
#: Products that a text may be the longest of until they are taken to their texts, not the texts to them.
MOST_ANCHORED = 10_000
#: Such texts that are told apart at most: their list is broadcast.
MOST_HOT = 100_000


def theme_prep(enriched: DataFrame, min_reviews: int = THEME_MIN_REVIEWS) -> DataFrame:
    """Product x sentiment groups with enough reviews for theme extraction."""
    out = (
        enriched.groupBy("parent_asin", "product_title", "store", "sentiment")
        .agg(F.count(F.lit(1)).alias("review_count"), F.avg("rating").alias("avg_rating"))
        .filter(F.col("review_count") >= min_reviews)
        .withColumn("avg_rating", round_half_up("avg_rating", 2))
    )
    return conform(out, THEME_PREP)


def example_reviews(enriched: DataFrame, title_like: str, sentiment: str, n: int | None = 3) -> DataFrame:
    """Review title and whole text of one sentiment for products whose title
    contains ``title_like`` (case-sensitive, as published).  ``n`` keeps the
    first n rows in a total order over all projected values."""
    rows = enriched.filter(F.col("product_title").contains(title_like) & (F.col("sentiment") == sentiment)).select(
        "parent_asin", "product_title", "review_title", "text", "rating", "helpful_vote"
    )
    if n is None:
        return rows
    order = [
        F.desc("helpful_vote"),
        F.asc_nulls_first("parent_asin"),
        F.asc_nulls_first("review_title"),
        F.asc_nulls_first("text"),
        F.asc_nulls_first("rating"),
    ]
    return rows.orderBy(*order).limit(n)


def review_keys(reviews: DataFrame) -> DataFrame:
    """``reviews`` that have a text, with narrow columns in its stead: its first
    ``HEAD_CHARS`` characters, which sort as the text does, its digest and its length."""
    return reviews.filter(F.col("text").isNotNull()).select(
        "parent_asin",
        "helpful_vote",
        F.substring("text", 1, HEAD_CHARS).alias("text_head"),
        F.xxhash64("text").alias("text_digest"),
        F.length("text").alias("text_length"),
        "text",
    )


def sample_keys(reviews: DataFrame, n: int = 3, only: DataFrame | None = None) -> DataFrame:
    """The keys of each product's first ``n`` distinct texts, and of all that tie with
    the last of them.  No text is shuffled: the exchanges carry product, votes,
    head and digest, and ``rank() <= n`` cuts each group on the map side.
    ``only``: the products (parent_asin) to rank, all if none are given."""
    return _first_keys(review_keys(reviews).drop("text"), n, only)


def _first_keys(narrow: DataFrame, n: int, only: DataFrame | None) -> DataFrame:
    if only is not None:
        narrow = narrow.join(only.select("parent_asin"), "parent_asin", "left_semi")
    order = Window.partitionBy("parent_asin").orderBy(F.desc("helpful_vote"), F.asc("text_head"))
    return narrow.distinct().withColumn("rn", F.rank().over(order)).filter(F.col("rn") <= n).drop("rn")


def shared_keys(texts: DataFrame) -> DataFrame:
    """(head, digest) that several of the distinct ``texts`` share.  Equal 64-bit digests
    of different texts are chance: under one pair among a billion texts."""
    return texts.groupBy(*TEXT_KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(*TEXT_KEYS)


class Stage(Protocol):
    """Keeps intermediate tables (``plans.staging``)."""

    def __call__(self, df: DataFrame, label: str) -> DataFrame: ...

    def drop(self, df: DataFrame) -> None: ...


class _InPlace:
    """Keeps nothing: all is one plan."""

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        return df

    def drop(self, df: DataFrame) -> None:
        pass


def sample_reviews(
    reviews: DataFrame,
    n: int = 3,
    sep: str = SAMPLE_SEPARATOR,
    only: DataFrame | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Up to ``n`` distinct review texts per product, most helpful first (equal
    votes by text), joined by ``sep``; of the products ``only`` if given.

    Late materialisation: products are ranked on narrow keys (``sample_keys``),
    then meet the texts of these keys, which are de-duplicated before their shuffle.
    A product whose keys say which texts it has (nearly all) goes to the longest of
    them: only its shorter texts are moved (``_at_longest``).  Where more than ``n``
    keys tie by their heads, the texts go to the product and are ranked there.  Where
    several texts share a head and a digest (``shared_keys``, next to none), the key
    does not name its text: there the reviews themselves are asked which texts they
    hold, and all are ranked by the text itself, so the result is exact.

    Reads review columns only: raw and enriched reviews give the same rows, and
    raw ones spare the text the enrichment join.  ``stage`` keeps intermediate
    tables, so that the reviews are shuffled for one purpose at a time."""
    keep = stage or _InPlace()
    rows = review_keys(reviews)
    narrow = keep(rows.drop("text"), "text-keys")
    marked = keep(_marked(_first_keys(narrow, n, only), n), "sample-keys")
    keep.drop(narrow)
    keys = marked.select(*narrow.columns)
    texts = keep(rows.select(*TEXT_KEYS, "text").distinct(), "sample-texts")
    shared = keep(shared_keys(texts), "shared-keys")
    # a staged list can be asked: if no texts share a key, no review has to be
    told_apart = stage is not None and shared.isEmpty()
    shared = F.broadcast(shared)
    flagged = _contested(marked if told_apart else marked.join(shared.withColumn("shared", F.lit(True)), [*TEXT_KEYS], "left"))
    settled = _at_longest(flagged.filter(~F.col("contested")), texts, sep)
    open_keys = flagged.filter("contested")
    named = (open_keys if told_apart else open_keys.filter("shared is null")).join(texts, [*TEXT_KEYS]).select("parent_asin", "helpful_vote", "text")
    if not told_apart:
        doubtful, kept = rows.join(shared, [*TEXT_KEYS], "left_semi"), keys.join(shared, [*TEXT_KEYS], "left_semi")
        kept = kept.select(*[F.col(c).alias(f"__{c}") for c in keys.columns])
        same = [doubtful[c] == kept[f"__{c}"] if c in TEXT_KEYS else doubtful[c].eqNullSafe(kept[f"__{c}"]) for c in keys.columns]
        named = named.unionByName(doubtful.join(kept, same, "left_semi").select("parent_asin", "helpful_vote", "text").distinct())
    # more keys than shown: each task cuts a product to its first n texts before they move
    ranked = named.withColumn(
        "rn",
        F.row_number().over(Window.partitionBy("parent_asin").orderBy(F.desc("helpful_vote"), F.asc("text"))),
    ).filter(F.col("rn") <= n)
    return settled.unionByName(
        ranked.groupBy("parent_asin").agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("rn", "text"))), lambda z: z["text"]),
                sep,
            ).alias("sample_reviews"),
            F.count(F.lit(1)).alias("sample_count"),
        )
    )


def _marked(keys: DataFrame, n: int) -> DataFrame:
    """``keys`` with the rank of their votes, the key of their product's longest text (``longest_*``)
    and whether the product has more keys than it shows (``unsettled``)."""
    product = Window.partitionBy("parent_asin")
    return (
        keys.withColumn("vote_rank", F.dense_rank().over(product.orderBy(F.desc("helpful_vote"))))
        .withColumn("longest", F.max(F.struct("text_length", *TEXT_KEYS)).over(product))
        .withColumn("unsettled", F.count(F.lit(1)).over(product) > n)
        .withColumns({f"longest_{c}": F.col("longest")[c] for c in TEXT_KEYS})
        .drop("longest")
    )


def _contested(marked: DataFrame) -> DataFrame:
    """``marked`` keys with whether the texts must go to the product (``contested``): more keys than it
    shows, one that several texts share, or a longest text that too many products would go to."""
    if "shared" in marked.columns:
        doubt = F.max(F.col("shared").isNotNull()).over(Window.partitionBy("parent_asin"))
        marked = marked.withColumn("unsettled", F.col("unsettled") | doubt)
    at = [f"longest_{c}" for c in TEXT_KEYS]
    hot = marked.select("parent_asin", *at).distinct().groupBy(*at).count().filter(F.col("count") > MOST_ANCHORED)
    hot = hot.orderBy(F.desc("count"), *at).limit(MOST_HOT).select(*at, F.lit(True).alias("hot"))
    return marked.join(F.broadcast(hot), at, "left").withColumn("contested", F.col("unsettled") | F.col("hot").isNotNull())


def _at_longest(keys: DataFrame, texts: DataFrame, sep: str) -> DataFrame:
    """The samples of products with no more keys than they show, put together where their longest
    text lies: it is not moved, and a text costs its shuffle only where a longer one is shown too."""
    at = [f"longest_{c}" for c in TEXT_KEYS]
    is_longest = (F.col("text_head") == F.col("longest_text_head")) & (F.col("text_digest") == F.col("longest_text_digest"))
    shorter = keys.filter(~is_longest).join(texts, [*TEXT_KEYS]).select("parent_asin", *at, "vote_rank", "text")
    awaited = keys.filter(is_longest).select("parent_asin", *at, "vote_rank", F.lit(None).cast("string").alias("text"))
    shown = (
        shorter.unionByName(awaited)
        .repartition(*at)
        .groupBy(*at, "parent_asin")
        .agg(F.collect_list(F.struct("vote_rank", "text")).alias("shown"))
    )
    # the texts under their own names, as above: one shuffle of them serves both joins
    shown = shown.withColumnsRenamed({f"longest_{c}": c for c in TEXT_KEYS})
    whole = F.transform("shown", lambda z: F.struct(z["vote_rank"].alias("vote_rank"), F.coalesce(z["text"], F.col("text")).alias("text")))
    return shown.join(texts, [*TEXT_KEYS]).select(
        "parent_asin",
        F.array_join(F.transform(F.array_sort(whole), lambda z: z["text"]), sep).alias("sample_reviews"),
        F.size("shown").cast("long").alias("sample_count"),
    )
