"""Adapter: review and product records derived from the shared test tables.

``reviews``  = lineitem joined to orders (reviewer) and documents (review text)
``products`` = part

Every lineitem row becomes one review and every part row one product; the
modulo rules below only *derive attribute values* (a missing rating, a NULL
store, a price written as text, an id without metadata, an id recorded twice)
so the enrichment rules meet NULLs, dirty values, unmatched reviews, unreviewed
products and duplicate metadata.  No rule filters rows.  Review text is drawn from the whole documents
table: document ``l_orderkey mod count(documents)`` (doc ids run 0..n-1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revscope.schemas import PRODUCTS_FULL, REVIEWS, conform
from revscope.sources.readers import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag", "l_shipdate",
    )
    # a single-file table splits only by row groups: widen the narrow key
    # columns before the text join so the text work uses every core
    li = spread(li, spark.sparkContext.defaultParallelism)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = docs.select(F.count(F.lit(1))).scalar()

    base = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").withColumn(
        "doc_slot", F.pmod(F.col("l_orderkey"), n_docs)
    )
    joined = base.join(docs, base.doc_slot == docs.doc_id, "left")
    key = F.col("l_orderkey")
    out = joined.select(
        # every 43rd product's reviews name an id without metadata, so its own product row is unreviewed
        F.concat(F.when(F.col("l_partkey") % 43 == 0, "X").otherwise("P"), F.col("l_partkey")).alias("parent_asin"),
        F.concat(F.lit("P"), F.col("l_partkey"), F.lit("-"), F.col("l_suppkey")).alias("asin"),
        F.concat(F.lit("U"), F.col("o_custkey")).alias("user_id"),
        F.when(key % 101 == 0, F.lit(None))
        .otherwise(F.least(F.lit(5), 1 + F.floor((F.col("l_quantity") + F.col("l_partkey") % 50) / 10)))
        .cast("double")
        .alias("rating"),
        F.concat(F.lit("Review "), F.col("l_linenumber")).alias("title"),
        F.when(key % 97 == 0, F.lit(None)).otherwise(F.col("text")).alias("text"),
        (F.unix_millis(F.col("l_shipdate").cast("timestamp")) + (key % 86400) * 1000).alias("timestamp"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("helpful_vote"),
    )
    return conform(out, REVIEWS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    out = part.select(
        # every 59th row is a second record of the id before it
        F.concat(F.lit("P"), F.when(key % 59 == 0, key - 1).otherwise(key)).alias("parent_asin"),
        F.col("p_type").alias("main_category"),
        F.col("p_name").alias("title"),
        ((10 + key % 41).cast("double") / 10).alias("average_rating"),
        F.when(key % 13 == 0, F.lit(None)).otherwise((key * 37) % 100000).cast("int").alias("rating_number"),
        F.array(F.col("p_name")).alias("features"),
        F.array(F.concat(F.col("p_type"), F.lit(" item"))).alias("description"),
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 19 == 0, F.concat(F.lit("from $"), F.col("p_size")))
        .otherwise(F.concat(F.lit("$"), F.format_string("%.2f", F.col("p_size") * 2.5)))
        .alias("price"),
        F.when(key % 29 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("store"),
        F.when(key % 31 == 0, F.lit(None))
        .when(key % 37 == 0, F.array().cast("array<string>"))
        .when(key % 7 == 0, F.array(F.lit("Goods")))
        .otherwise(F.array(F.lit("Goods"), F.col("p_type")))
        .alias("categories"),
        F.lit(None).cast("string").alias("details"),
        F.lit(None).cast("array<string>").alias("bought_together"),
        F.lit(None).cast("array<string>").alias("images"),
        F.lit(None).cast("array<string>").alias("videos"),
        F.lit(None).cast("string").alias("subtitle"),
        F.lit(None).cast("string").alias("author"),
    )
    return conform(out, PRODUCTS_FULL)
