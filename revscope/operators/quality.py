"""Quality checks over the published tables (U2-U4, S4, T15 report)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revscope.functions.numeric import round_half_up


def null_checks(trends: DataFrame, competitive: DataFrame) -> DataFrame:
    """Rows, NULL dates and NULL ratings per table."""

    def one(df: DataFrame, name: str, date_col: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(date_col).isNull()).alias("null_dates"),
            F.count_if(F.col("avg_rating").isNull()).alias("null_ratings"),
        )

    return one(trends, "sentiment_trends", "year_month").unionByName(
        one(competitive, "competitive_analysis", "first_review_date")
    )


def range_checks(trends: DataFrame, metrics: tuple = ("avg_rating", "positive_rate")) -> DataFrame:
    """min / max / mean per metric of the trends table from one aggregate
    pass, unpivoted to one row per metric (U3); the mean is rounded to 4 places."""
    wide = trends.agg(
        *[
            agg(F.col(m)).alias(f"{name}_{i}")
            for i, m in enumerate(metrics)
            for name, agg in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.col(f"min_{i}").alias("min_value"),
                    F.col(f"max_{i}").alias("max_value"),
                    round_half_up(F.col(f"avg_{i}"), 4).alias("avg_value"),
                )
                for i, m in enumerate(metrics)
            ]
        )
    )
    return wide.select(rows.alias("r")).select("r.*")


def published_measures() -> dict[str, dict[str, Column]]:
    """The null and range checks (U2, U3) as aggregates by table and name, to be observed while a table is written."""

    def nulls(date_col: str) -> dict[str, Column]:
        return {"null_dates": F.count_if(F.col(date_col).isNull()), "null_ratings": F.count_if(F.col("avg_rating").isNull())}

    ranges = {f"{name}_{m}": agg(m) for m in ("avg_rating", "positive_rate") for name, agg in (("min", F.min), ("max", F.max))}
    return {"sentiment_trends": nulls("year_month") | ranges, "competitive_analysis": nulls("first_review_date")}


def feature_summary(
    trends: DataFrame, competitive: DataFrame, prediction: DataFrame, velocity: DataFrame
) -> DataFrame:
    """Rows, distinct stores, earliest and latest date per table (U4).  The
    success table has no dates; its date columns are typed NULL DATEs."""
    null_date = F.lit(None).cast("date")
    parts = [
        trends.agg(
            F.lit("Sentiment Trends").alias("feature"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("store").alias("unique_stores"),
            F.min("year_month").alias("earliest_date"),
            F.max("year_month").alias("latest_date"),
        ),
        competitive.agg(
            F.lit("Competitive Analysis").alias("feature"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("store").alias("unique_stores"),
            F.min("first_review_date").alias("earliest_date"),
            F.max("last_review_date").alias("latest_date"),
        ),
        prediction.agg(
            F.lit("Success Prediction").alias("feature"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("store").alias("unique_stores"),
            null_date.alias("earliest_date"),
            null_date.alias("latest_date"),
        ),
        velocity.agg(
            F.lit("Review Velocity").alias("feature"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("store").alias("unique_stores"),
            F.min("year_month").alias("earliest_date"),
            F.max("year_month").alias("latest_date"),
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_errors(parsed: DataFrame, corrupt_column: str = "_corrupt_record") -> DataFrame:
    """Rows that did not parse, with their raw text (S4).  Spark refuses
    queries that reference only the corrupt-record column of an un-cached
    JSON scan, so callers pass a persisted or checkpointed read."""
    return parsed.filter(F.col(corrupt_column).isNotNull()).select(corrupt_column)


def duplicate_products(products: DataFrame) -> DataFrame:
    """Product ids that occur more than once in the metadata (T15): such ids
    multiply their reviews in the enrichment join."""
    return (
        products.groupBy("parent_asin")
        .agg(F.count(F.lit(1)).alias("metadata_rows"))
        .filter(F.col("metadata_rows") > 1)
    )
