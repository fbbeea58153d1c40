"""The batch job (E3, M1, M2): load -> enrich -> four feature tables -> write.

Scale notes
* The enrichment join runs once.  Its narrow projection (only the columns
  the feature builders read; no review text, no arrays) is materialised
  either as a written Parquet table in the shared checkpoint folder
  (default: survives executor loss, cuts lineage, later scans prune
  columns) or as a MEMORY_AND_DISK persist.
* Each feature is an aggregate with map-side partial aggregation, so the
  shuffles carry per-task group rows, not review rows.
* success_prediction is a projection of competitive_analysis read back from
  its written table (M2), so the competitive aggregate is not recomputed.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revscope.operators.competitive import competitive_analysis
from revscope.operators.enrich import add_review_columns, join_products
from revscope.operators.sentiment import sentiment_trends
from revscope.operators.success import success_prediction
from revscope.operators.velocity import velocity_analysis
from revscope.operators.profile import completeness
from revscope.operators.quality import feature_summary, null_checks, published_measures, range_checks
from revscope.schemas import FEATURE_TABLES
from revscope.session import ensure_checkpoint_dir, ensure_utc, session
from revscope.sources.readers import input_files, input_totals, read_feature_csv, read_products, read_reviews
from revscope.sources.writers import export_all_csv, write_feature

# ---- shuffle sizing defaults ----
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024   # bytes of (decompressed) input per initial shuffle partition
INPUT_EXPANSION = 0.5                       # bytes shuffled / stored size of gzip JSON: ids, ratings and dates, no texts
MOST_PARTITIONS = 50_000                    # map output bookkeeping on the driver grows with maps x partitions
# ----


def size_shuffle_partitions(
    spark: SparkSession,
    paths: list[str],
    target_bytes: int = SHUFFLE_TARGET_BYTES,
    expansion: float = INPUT_EXPANSION,
) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the measured input size.

    With AQE the setting is the *initial* partition count, which AQE then
    coalesces; it is never split, so on a large input it must be large
    enough that each partition fits comfortably in an executor.  The count
    is raised to ``ceil(total_bytes * expansion / target_bytes)``, at most
    ``MOST_PARTITIONS`` (beyond it partitions grow instead), and never
    lowered below the current value."""
    total = 0
    for path in paths:
        total += input_totals(input_files(spark, path)).first().total_bytes or 0
    wanted = min(MOST_PARTITIONS, max(1, -(-int(total * expansion) // target_bytes)))
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    chosen = max(current, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(chosen))
    return chosen

# Columns of the enriched reviews that the four feature builders read.
FEATURE_INPUT_COLUMNS = [
    "parent_asin", "product_title", "store", "main_category", "price_tier", "user_id", "rating",
    "sentiment", "review_length", "is_detailed_review", "verified_purchase", "helpful_vote",
    "review_date", "review_year_month",
]
# The review-side ones, as staged before the join (with the salt's columns).
REVIEW_INPUT_COLUMNS = [
    "parent_asin", "user_id", "timestamp", "title", "rating", "sentiment", "review_length", "is_detailed_review",
    "verified_purchase", "helpful_vote", "review_date", "review_year_month",
]


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this job wrote, through the cluster file system."""
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(path)
    fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, True)


def materialize(df: DataFrame, mode: str, spark: SparkSession, label: str = "enriched") -> tuple[DataFrame, callable]:
    """Materialise a shared intermediate result (M1).  Returns the frame to
    use and a cleanup callable."""
    if mode == "persist":
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        return kept, kept.unpersist
    if mode == "table":
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/revscope-{label}-{uuid.uuid4().hex[:12]}"
        df.write.mode("overwrite").parquet(folder)
        return spark.read.parquet(folder), (lambda: _delete(spark, folder))
    if mode == "none":
        return df, (lambda: None)
    raise ValueError(f"unknown materialize mode {mode!r}")


def build_features(
    enriched: DataFrame,
    spark: SparkSession,
    target: str,
    mode: str = "table",
    success_kwargs: dict | None = None,
) -> dict:
    """Write the four feature tables under ``target``; returns row counts and timings."""
    base, cleanup = materialize(enriched.select(*FEATURE_INPUT_COLUMNS), mode, spark)
    report: dict = {"rows": {}, "seconds": {}}
    try:
        for name, build in (
            ("sentiment_trends", sentiment_trends),
            ("competitive_analysis", competitive_analysis),
            ("review_velocity", velocity_analysis),
        ):
            t0 = time.time()
            report["rows"][name] = write_feature(build(base), f"{target}/{name}", name)
            report["seconds"][name] = round(time.time() - t0, 3)
        t0 = time.time()
        written = spark.read.parquet(f"{target}/competitive_analysis")
        report["rows"]["success_prediction"] = write_feature(
            success_prediction(written, **(success_kwargs or {})), f"{target}/success_prediction", "success"
        )
        report["seconds"]["success_prediction"] = round(time.time() - t0, 3)
    finally:
        cleanup()
    return report


def run_pipeline(
    spark: SparkSession,
    reviews_path: str,
    products_path: str,
    target: str,
    mode: str = "table",
    min_partitions: int | None = None,
    success_kwargs: dict | None = None,
    size_shuffles: bool = True,
) -> dict:
    """Load JSON inputs, enrich, build and write the four tables.
    ``size_shuffles`` sets the initial shuffle partition count from the
    input size (see ``size_shuffle_partitions``)."""
    ensure_utc(spark)
    started = time.time()
    before = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        shuffle_partitions = (
            size_shuffle_partitions(spark, [reviews_path, products_path]) if size_shuffles else None
        )
        products = read_products(spark, products_path, min_partitions=min_partitions)
        # the narrow columns are staged once: counting and joining would decompress the source twice
        reviews = add_review_columns(read_reviews(spark, reviews_path, min_partitions=min_partitions))
        narrow, cleanup = materialize(reviews.select(*REVIEW_INPUT_COLUMNS), "table" if mode == "table" else "none", spark, "reviews")
        try:
            report = build_features(join_products(narrow, products), spark, target.rstrip("/"), mode, success_kwargs)
        finally:
            cleanup()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    report["shuffle_partitions"] = shuffle_partitions
    report["elapsed_seconds"] = round(time.time() - started, 3)
    return report


def publish(spark: SparkSession, target: str, csv_target: str) -> dict:
    """The publish flow over the tables ``run_pipeline`` wrote under ``target``:
    headered CSV, typed read-back, and the checks of what was published.

    ``status`` has a row for each table, with its null and range checks as ``measures``,
    observed by the writing job itself.  If all were written: ``completeness``
    of each column, ``null_checks`` (rows, NULL dates and ratings), ``range_checks``
    (least, greatest and mean rating and positive rate), ``summary`` (rows, stores
    and dates of each table) and ``row_checks`` (rows read back against rows
    written), all as DataFrames over the tables as read back (``tables``)."""
    names = list(FEATURE_TABLES)
    status = export_all_csv(spark, target, csv_target, names, measures=published_measures())
    report = {"status": status}
    if any(r.status != "OK" for r in status.collect()):  # a row a table
        return report
    typed = {name: read_feature_csv(spark, f"{csv_target.rstrip('/')}/{name}", FEATURE_TABLES[name]) for name in names}
    trends, profile, prediction, velocity = (typed[n] for n in ("sentiment_trends", "competitive_analysis", "success_prediction", "review_velocity"))
    counts = None
    for name, df in typed.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("read_rows"))
        counts = one if counts is None else counts.unionByName(one)
    rows = status.join(counts, "table_name").select("table_name", "rows", "read_rows", (F.col("rows") == F.col("read_rows")).alias("same"))
    return report | {
        "completeness": {name: completeness(df) for name, df in typed.items()},
        "null_checks": null_checks(trends, profile),
        "range_checks": range_checks(trends),
        "summary": feature_summary(trends, profile, prediction, velocity),
        "row_checks": rows,
        "tables": typed,
    }


def failed_checks(report: dict) -> list[str]:
    """What of a publish report is wrong, in words; nothing if all is well.

    Rows that differ, tables without rows, NULL months, and values out of range:
    a mean rating outside 1 to 5, a positive rate outside 0 to 100."""
    wrong = [f"{r.table_name}: {r.error}" for r in report["status"].collect() if r.status != "OK"]
    if wrong:
        return wrong
    wrong += [f"{r.table_name}: {r.rows} rows written, {r.read_rows} read" for r in report["row_checks"].collect() if not r.same]
    wrong += [f"{r.feature}: no rows" for r in report["summary"].collect() if not r.row_count]
    bounds = {"avg_rating": (1, 5), "positive_rate": (0, 100)}
    for r in report["range_checks"].collect():
        low, high = bounds[r.metric]
        if r.min_value is not None and (r.min_value < low or r.max_value > high):
            wrong.append(f"{r.metric}: {r.min_value} to {r.max_value}")
    return wrong


def main(arguments: list[str] | None = None) -> int:
    """``python -m revscope.plans.job REVIEWS PRODUCTS TARGET [--csv FOLDER]``: 0 if all tables were written."""
    parser = argparse.ArgumentParser(description="Build the feature tables from review and product records.")
    parser.add_argument("reviews")
    parser.add_argument("products")
    parser.add_argument("target")
    parser.add_argument("--csv", help="also publish headered CSV tables into this folder")
    parser.add_argument("--mode", choices=("table", "persist", "none"), default="table")
    parser.add_argument("--min-partitions", type=int)
    given = parser.parse_args(arguments)
    spark = session("revscope-job")
    report = run_pipeline(spark, given.reviews, given.products, given.target, given.mode, given.min_partitions)
    failed = 0
    if given.csv:
        published = publish(spark, given.target, given.csv)
        rows = published["status"].collect()  # a row for each of the four tables
        report["csv"] = {r.table_name: r.rows if r.status == "OK" else r.error for r in rows}
        report["failed_checks"] = failed_checks(published)
        failed = len(report["failed_checks"])
    print(json.dumps(report))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
