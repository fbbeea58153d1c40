"""Streaming review velocity (A12 on a stream).

reviews stream -> foreachBatch: monthly (product, month) counts and rating
sums of the micro-batch, written to its own ``batch_id=<n>`` folder.

* The written rows are partial sums: a month's count is the sum over all
  batches, so a review that arrives late, by however much, corrects its month.
  No watermark decides what counts, and the stream keeps no state.
* The sink overwrites its batch folder, so a micro-batch replayed after a
  failure replaces its own output instead of duplicating it.
* ``read_velocity`` adds the partial sums up, joins the product metadata (a
  row a month by then, not a review, so no key is hot) and takes the previous
  existing month, as the batch job does.  ``compact`` folds many batches into
  one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revscope.functions.dates import review_date, year_month
from revscope.functions.labels import momentum
from revscope.functions.numeric import round_half_up, smoothed_pct
from revscope.operators.enrich import product_dim
from revscope.schemas import REVIEW_VELOCITY, REVIEWS, conform

PARTIALS = "parent_asin string, year_month date, monthly_reviews long, rated long, rating_sum double, batch_id long"


def read_review_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Review records arriving as files in ``path`` (declared schema)."""
    reader = spark.readStream.schema(REVIEWS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def partial_counts(reviews: DataFrame) -> DataFrame:
    """Count and rating sum by product and month; sums of these are the whole's."""
    dated = reviews.select("parent_asin", year_month(review_date("timestamp")).alias("year_month"), "rating")
    return dated.groupBy("parent_asin", "year_month").agg(
        F.count(F.lit(1)).alias("monthly_reviews"),
        F.count("rating").alias("rated"),
        F.sum(F.col("rating").cast("double")).alias("rating_sum"),
    )


def velocity_sink(output_path: str):
    """foreachBatch function writing the partial counts of each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_counts(batch).write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")

    return write


def start_velocity_stream(reviews: DataFrame, output_path: str, checkpoint_path: str, available_now: bool = False):
    """Start the streaming query; returns the ``StreamingQuery``."""
    writer = reviews.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(velocity_sink(output_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_partials(spark: SparkSession, output_path: str) -> DataFrame:
    """The partial counts written so far; an unreadable folder is an error, not an empty one."""
    return spark.read.schema(PARTIALS).parquet(output_path)


def read_velocity(spark: SparkSession, output_path: str, products: DataFrame, before: str | None = None) -> DataFrame:
    """The velocity table of all reviews received so far, or of months before
    ``before`` (a date), for readers who want only months past."""
    partials = read_partials(spark, output_path)
    if before:
        partials = partials.filter(F.col("year_month") < F.lit(before).cast("date"))
    sums = [F.sum(c).alias(c) for c in ("monthly_reviews", "rated", "rating_sum")]
    months = partials.groupBy("parent_asin", "year_month").agg(*sums)
    dim = product_dim(products).select("parent_asin", "product_title", "store")
    monthly = (
        months.join(dim, on="parent_asin", how="left")
        .groupBy("parent_asin", "product_title", "store", "year_month")
        .agg(*sums)
        .withColumn("monthly_avg_rating", round_half_up(F.try_divide("rating_sum", "rated"), 2))
    )
    by_product = Window.partitionBy("parent_asin").orderBy("year_month", "product_title", "store")
    out = (
        monthly.withColumn("prev_month_reviews", F.lag("monthly_reviews", 1).over(by_product))
        .withColumn("velocity_change", F.col("monthly_reviews") - F.col("prev_month_reviews"))
        .withColumn("velocity_change_pct", smoothed_pct("monthly_reviews", "prev_month_reviews"))
        .withColumn("momentum", momentum("velocity_change_pct"))
    )
    return conform(out, REVIEW_VELOCITY)


def compact(spark: SparkSession, output_path: str, compacted_path: str) -> None:
    """All batches' partial counts as one batch of a new folder, for a stopped stream's output."""
    sums = [F.sum(c).alias(c) for c in ("monthly_reviews", "rated", "rating_sum")]
    folded = read_partials(spark, output_path).groupBy("parent_asin", "year_month").agg(*sums)
    folded.write.mode("overwrite").parquet(f"{compacted_path}/batch_id=-1")
