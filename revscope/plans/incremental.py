"""The batch job day by day (M1, M2, E3): each batch costs its own reviews and the states.

``add_batch`` enriches one batch of reviews and writes its partial states
(``operators.states``), its reviewers (``operators.reviewers``) and its monthly
sketches under ``target/<state>/batch=<id>``, by dynamic partition overwrite: a
batch that is run again replaces what it wrote, so a job that failed half way is
simply repeated.  ``rebuild`` makes the four feature tables from the states
alone; they equal those of one run over all reviews.  ``compact`` merges the
batches up to one into that one, so the number of states stays bounded.

The attributes of a product are those its metadata had when a batch was added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from revscope.operators.enrich import add_review_columns, join_products
from revscope.operators.reviewers import DENSE_REVIEWS, merge_reviewers, reviewer_ids, reviewer_states, unique_reviewers
from revscope.operators.states import (
    competitive_from_states,
    merge_sketches,
    merge_states,
    review_states,
    sketch_states,
    trends_from_states,
    velocity_from_states,
)
from revscope.operators.success import success_prediction
from revscope.plans.job import FEATURE_INPUT_COLUMNS, REVIEW_INPUT_COLUMNS, materialize
from revscope.session import ensure_utc
from revscope.sources.writers import write_feature

STATES, REVIEWERS, SKETCHES, IDS = "states", "reviewers", "sketches", "reviewer_ids"
MERGE = {STATES: merge_states, REVIEWERS: merge_reviewers, SKETCHES: merge_sketches}


def _put(df: DataFrame, target: str, kind: str, batch: str) -> None:
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(f"{target}/{kind}")
    )


def stored(spark: SparkSession, target: str, kind: str) -> DataFrame | None:
    """All batches of one kind of state, with their ``batch``; None before the first.

    Batch ids are text: type inference would read 007 as 7."""
    try:
        rows = spark.read.parquet(f"{target}/{kind}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), "/batch=([^/]*)/", 1))


def add_batch(spark: SparkSession, reviews: DataFrame, products: DataFrame, target: str, batch: str, mode: str = "table", dense_reviews: int = DENSE_REVIEWS) -> None:
    """Write the states of one batch of reviews (raw records); the same ``batch`` again replaces them."""
    if not batch.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a batch id is made of letters, digits, - and _")
    ensure_utc(spark)
    target = target.rstrip("/")
    narrow = add_review_columns(reviews).select(*REVIEW_INPUT_COLUMNS)
    base, cleanup = materialize(join_products(narrow, products).select(*FEATURE_INPUT_COLUMNS), mode, spark, "batch")
    try:
        held = stored(spark, target, IDS)
        # this batch's own ids of an earlier attempt are made anew: ids only ever say who is the same
        known = held.filter(F.col("batch") != batch).select("user_id", "reviewer") if held is not None else None
        ids, drop_ids = materialize(reviewer_ids(base, known), mode, spark, "ids")
        try:
            fresh = ids if known is None else ids.join(known.select("user_id"), "user_id", "left_anti")
            _put(reviewer_states(base, ids, dense_reviews), target, REVIEWERS, batch)
            _put(review_states(base), target, STATES, batch)
            _put(sketch_states(base), target, SKETCHES, batch)
            _put(fresh, target, IDS, batch)
        finally:
            drop_ids()
    finally:
        cleanup()


def merged(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """One kind of state over all batches."""
    return MERGE[kind](stored(spark, target.rstrip("/"), kind).drop("batch"))


def rebuild(spark: SparkSession, target: str, features: str, success_kwargs: dict | None = None) -> dict[str, int]:
    """Write the four feature tables under ``features`` from the states of all batches; returns row counts."""
    features = features.rstrip("/")
    states = merged(spark, target, STATES)
    unique = unique_reviewers(merged(spark, target, REVIEWERS))
    rows = {
        "sentiment_trends": write_feature(trends_from_states(states), f"{features}/sentiment_trends", "trends"),
        "competitive_analysis": write_feature(competitive_from_states(states, unique), f"{features}/competitive_analysis", "profile"),
        "review_velocity": write_feature(velocity_from_states(states), f"{features}/review_velocity", "velocity"),
    }
    written = spark.read.parquet(f"{features}/competitive_analysis")
    rows["success_prediction"] = write_feature(success_prediction(written, **(success_kwargs or {})), f"{features}/success_prediction", "success")
    return rows


def compact(spark: SparkSession, target: str, upto: str, mode: str = "table") -> int:
    """Merge the batches up to ``upto`` (in text order) into that one; returns how many went into it.

    Each kind's merged states replace ``upto`` before the others are deleted; a run
    that fails in between must be followed by adding the batches anew.  Do not add
    batches meanwhile."""
    target = target.rstrip("/")
    old = [r.batch for r in stored(spark, target, STATES).filter(F.col("batch") <= upto).select("batch").distinct().orderBy("batch").collect()]
    if upto not in old:
        raise ValueError(f"no batch {upto!r}")
    gone = [b for b in old if b != upto]
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for kind in (STATES, REVIEWERS, SKETCHES, IDS):
        rows = stored(spark, target, kind).filter(F.col("batch") <= upto).drop("batch")
        whole, cleanup = materialize(MERGE[kind](rows) if kind in MERGE else rows, mode, spark, "compact")
        try:
            _put(whole, target, kind, upto)
        finally:
            cleanup()
        for b in gone:
            path = fs.Path(f"{target}/{kind}/batch={b}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)

