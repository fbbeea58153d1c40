"""Exact distinct reviewers by bitmaps over dense reviewer ids (A10).

``count_distinct`` keeps (product, reviewer) pairs, which cannot be added up
later.  Here every reviewer has a dense id, and a product with many reviews a
bitmap of its reviewers' ids, in buckets of 32,768: bitmaps are OR-ed map-side,
never ship a pair, and merge with those of other days.  A product with few
reviews would waste a 4 kB bitmap on each, so its pairs are kept as they are;
where it has both, the pairs join the bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revscope.operators.competitive import PRODUCT_KEYS

#: Reviews for each bucket from which on a product's reviewers go to bitmaps.
DENSE_REVIEWS = 10_000
#: Runs that ids are dealt in; an id is its run's count so far times the runs, plus the run.
ID_RUNS = 1024
#: Products of the dense list at most: it is broadcast (one beyond them keeps pairs).
MOST_DENSE = 100_000
#: Buckets of ids whose pairs of one product are dealt to one task.
DEALT_BUCKETS = 256


def reviewer_ids(reviews: DataFrame, known: DataFrame | None = None, runs: int = ID_RUNS) -> DataFrame:
    """(user_id, reviewer): a dense id for each distinct reviewer; ``known`` ids stay as they are.

    Reviewers are dealt to ``runs`` by hash and numbered inside their run, so no
    task sees all of them; ids are dense up to the unevenness of the runs."""
    users = reviews.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    if known is not None:
        users = users.join(known.select("user_id"), "user_id", "left_anti")
    rows = users.withColumn("run", F.pmod(F.xxhash64("user_id"), F.lit(runs)))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("run").orderBy("user_id")) - 1)
    if known is None:
        return rows.select("user_id", (F.col("place") * F.lit(runs) + F.col("run")).cast("long").alias("reviewer"))
    used = known.groupBy(F.pmod("reviewer", F.lit(runs)).alias("run")).agg((F.floor(F.max("reviewer") / F.lit(runs)) + 1).alias("used"))
    rows = rows.join(F.broadcast(used), "run", "left")  # a row a run
    fresh = rows.select("user_id", ((F.col("place") + F.coalesce("used", F.lit(0))) * F.lit(runs) + F.col("run")).cast("long").alias("reviewer"))
    return known.select("user_id", "reviewer").unionByName(fresh)


def dealt_by(parent_asin: str = "parent_asin", bucket: str = "bucket") -> Column:
    """The run of buckets that a state row is dealt by, beside its product: rows of a product's few
    reviewers lie together, those of many (or of no product) are spread, ``DEALT_BUCKETS`` buckets a task."""
    run = F.when(F.col(parent_asin).isNull(), F.col(bucket)).otherwise(F.floor(F.col(bucket) / F.lit(DEALT_BUCKETS)))
    return run.cast("long")


def reviewer_states(
    enriched: DataFrame, ids: DataFrame, dense_reviews: int = DENSE_REVIEWS, keys: Sequence[str] = PRODUCT_KEYS, by: Sequence[str] = ()
) -> DataFrame:
    """(product keys, run, bucket, bitmap, place): a bitmap for each dense product and bucket, a row for each other pair.

    Dense is a product with more than ``dense_reviews`` reviews for each bucket that ids
    reach: its reviewers are dealt over all buckets, and a 4 kB bitmap that holds one
    or two of them would be far larger than their pairs.  ``keys``: what names a product,
    parent_asin at least.  ``by``: columns that tell batches apart; the states of all are
    then made in one pass.

    Pairs are dealt once, by product and run of buckets: merging and counting them needs no
    shuffle after this one."""
    buckets = ids.select(F.greatest(F.max(F.bitmap_bucket_number("reviewer")), F.lit(1))).scalar()
    named = [*by, "parent_asin"]
    counts = enriched.groupBy(*named).count().filter((F.col("count") > F.lit(dense_reviews) * buckets) & F.col("parent_asin").isNotNull())
    largest = counts.orderBy(F.desc("count"), *named).limit(MOST_DENSE)
    dense = F.broadcast(largest.select(*[F.col(c).alias(f"__{c}") for c in named], F.lit(True).alias("dense")))
    numbered = enriched.select(*keys, *by, "user_id").join(ids, "user_id")
    # null-safe: a plain equality would filter one branch's reviews for it, and the shuffle to the ids be made twice
    same = reduce(lambda a, b: a & b, [numbered[c].eqNullSafe(dense[f"__{c}"]) for c in named])
    placed = numbered.join(dense, same, "left").select(
        *keys, *by, "dense", F.bitmap_bucket_number("reviewer").alias("bucket"), F.bitmap_bit_position("reviewer").alias("place")
    ).withColumn("run", dealt_by())
    bits = placed.filter("dense").groupBy(*keys, *by, "run", "bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    pairs = placed.filter("dense is null").select(*keys, *by, "run", "bucket", "place").repartition("parent_asin", "run").distinct()
    return _states(bits, pairs)


def _states(bits: DataFrame, pairs: DataFrame) -> DataFrame:
    no_bitmap = pairs.withColumn("bitmap", F.lit(None).cast("binary"))
    # never null, which Spark does not know of the aggregate: who asks for pairs then gets no branch of bitmaps
    bits = bits.withColumn("bitmap", F.coalesce("bitmap", F.lit(bytearray())))
    return bits.withColumn("place", F.lit(None).cast("long")).unionByName(no_bitmap)


def _dealt(states: DataFrame) -> DataFrame:
    """``states`` with their run, which those stored by earlier versions lack."""
    return states if "run" in states.columns else states.withColumn("run", dealt_by())


def merge_reviewers(*states: DataFrame, keys: Sequence[str] = PRODUCT_KEYS) -> DataFrame:
    """The states of all reviews whose states are given: bitmaps OR-ed, pairs once."""
    rows = reduce(DataFrame.unionByName, map(_dealt, states))
    by = [*keys, "run", "bucket"]
    bits = rows.filter("bitmap is not null").groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return _states(bits, rows.filter("bitmap is null").select(*by, "place").distinct())


def unique_reviewers(states: DataFrame, keys: Sequence[str] = PRODUCT_KEYS) -> DataFrame:
    """(product keys, unique_reviewers), exact: a bucket's bits and its pairs counted together.

    Pairs join bitmaps only where their product and run have some; the distinct pairs of
    the others are counted where they lie."""
    rows = _dealt(states)
    by = [*keys, "run", "bucket"]
    bits = rows.filter("bitmap is not null").groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    pairs = rows.filter("bitmap is null").select(*by, "place").distinct()
    # bits are of no null; said so, the join has no null check to put below the shuffles that both sides share
    held = bits.select(F.coalesce("parent_asin", F.lit("")).alias("parent_asin"), F.coalesce("run", F.lit(-1)).alias("run"))
    held = held.distinct().withColumn("held", F.lit(True))
    met = pairs.join(held, ["parent_asin", "run"], "left")
    # where and whether bits are held is asked together: asked alone, it would make an inner join, whose
    # null checks reach below the pairs' shuffle, and that be made twice
    joining = met.filter(F.when(F.col("place") >= 0, F.col("held")).otherwise(F.lit(False)))
    joined = joining.groupBy(*by).agg(F.bitmap_construct_agg("place").alias("bitmap"))
    counted = bits.unionByName(joined).groupBy(*by).agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    alone = met.filter("held is null").groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("n"))
    both = counted.select(*keys, "n").unionByName(alone.select(*keys, "n"))
    return both.groupBy(*keys).agg(F.sum("n").cast("long").alias("unique_reviewers"))
