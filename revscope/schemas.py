"""Input schemas and output contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


REVIEWS = _struct(
    ("parent_asin", StringType()),
    ("asin", StringType()),
    ("user_id", StringType()),
    ("rating", DoubleType()),
    ("title", StringType()),
    ("text", StringType()),
    ("timestamp", LongType()),
    ("verified_purchase", BooleanType()),
    ("helpful_vote", LongType()),
)

# The nine declared metadata fields of the batch job.
PRODUCTS = _struct(
    ("parent_asin", StringType()),
    ("title", StringType()),
    ("main_category", StringType()),
    ("store", StringType()),
    ("price", StringType()),
    ("features", ArrayType(StringType())),
    ("description", ArrayType(StringType())),
    ("average_rating", DoubleType()),
    ("rating_number", IntegerType()),
)

# The 16-field superset used by the exploration steps.
PRODUCTS_FULL = _struct(
    ("parent_asin", StringType()),
    ("main_category", StringType()),
    ("title", StringType()),
    ("average_rating", DoubleType()),
    ("rating_number", IntegerType()),
    ("features", ArrayType(StringType())),
    ("description", ArrayType(StringType())),
    ("price", StringType()),
    ("store", StringType()),
    ("categories", ArrayType(StringType())),
    ("details", StringType()),
    ("bought_together", ArrayType(StringType())),
    ("images", ArrayType(StringType())),
    ("videos", ArrayType(StringType())),
    ("subtitle", StringType()),
    ("author", StringType()),
)

SENTIMENT_TRENDS = _struct(
    ("store", StringType()),
    ("year_month", DateType()),
    ("review_count", LongType()),
    ("avg_rating", DoubleType()),
    ("positive_count", LongType()),
    ("negative_count", LongType()),
    ("neutral_count", LongType()),
    ("positive_rate", DoubleType()),
    ("negative_rate", DoubleType()),
    ("rating_change", DoubleType()),
    ("trend_direction", StringType()),
)

COMPETITIVE_ANALYSIS = _struct(
    ("parent_asin", StringType()),
    ("product_title", StringType()),
    ("store", StringType()),
    ("main_category", StringType()),
    ("price_tier", StringType()),
    ("total_reviews", LongType()),
    ("unique_reviewers", LongType()),
    ("avg_rating", DoubleType()),
    ("rating_stddev", DoubleType()),
    ("positive_reviews", LongType()),
    ("negative_reviews", LongType()),
    ("neutral_reviews", LongType()),
    ("satisfaction_rate", DoubleType()),
    ("negative_rate", DoubleType()),
    ("avg_review_length", DoubleType()),
    ("detailed_reviews", LongType()),
    ("verified_purchases", LongType()),
    ("verified_rate", DoubleType()),
    ("avg_helpful_votes", DoubleType()),
    ("first_review_date", DateType()),
    ("last_review_date", DateType()),
    ("review_span_days", IntegerType()),
)

SUCCESS_PREDICTION = _struct(
    ("parent_asin", StringType()),
    ("product_title", StringType()),
    ("store", StringType()),
    ("success_score", DoubleType()),
    ("success_category", StringType()),
    ("satisfaction_rate", DoubleType()),
    ("rating_stddev", DoubleType()),
    ("verified_rate", DoubleType()),
    ("review_velocity", DoubleType()),
    ("engagement_score", DoubleType()),
)

REVIEW_VELOCITY = _struct(
    ("parent_asin", StringType()),
    ("product_title", StringType()),
    ("store", StringType()),
    ("year_month", DateType()),
    ("monthly_reviews", LongType()),
    ("monthly_avg_rating", DoubleType()),
    ("prev_month_reviews", IntegerType()),
    ("velocity_change", IntegerType()),
    ("velocity_change_pct", DoubleType()),
    ("momentum", StringType()),
)

THEME_PREP = _struct(
    ("parent_asin", StringType()),
    ("product_title", StringType()),
    ("store", StringType()),
    ("sentiment", StringType()),
    ("review_count", LongType()),
    ("avg_rating", DoubleType()),
)

# Warehouse names of the four published tables.
FEATURE_TABLES = {
    "sentiment_trends": SENTIMENT_TRENDS,
    "competitive_analysis": COMPETITIVE_ANALYSIS,
    "success_prediction": SUCCESS_PREDICTION,
    "review_velocity": REVIEW_VELOCITY,
}

# Narrowed warehouse types (DECIMAL(10,2) money/rates, (10,3) rating change,
# INTEGER counts) used when the tables are created as typed tables.
WAREHOUSE_DECIMALS = {
    "avg_rating": "decimal(10,2)",
    "positive_rate": "decimal(10,2)",
    "negative_rate": "decimal(10,2)",
    "rating_change": "decimal(10,3)",
    "rating_stddev": "decimal(10,2)",
    "satisfaction_rate": "decimal(10,2)",
    "avg_review_length": "decimal(10,2)",
    "verified_rate": "decimal(10,2)",
    "avg_helpful_votes": "decimal(10,2)",
    "success_score": "decimal(10,2)",
    "review_velocity": "decimal(10,2)",
    "engagement_score": "decimal(10,2)",
    "monthly_avg_rating": "decimal(10,2)",
    "velocity_change_pct": "decimal(10,2)",
}


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Select exactly the contract's columns, in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def require_columns(spark: SparkSession, df: DataFrame, required: dict[str, str]) -> DataFrame:
    """Presence report for required columns (F3): column, purpose, present."""
    present = set(df.columns)
    rows = [(name, purpose, name in present) for name, purpose in required.items()]
    return spark.createDataFrame(rows, "column_name string, purpose string, present boolean")


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """table/column/type/position listing of DataFrames' schemas."""
    rows = [
        (table, field.name, field.dataType.simpleString(), pos)
        for table, df in tables.items()
        for pos, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal_position int"
    )
