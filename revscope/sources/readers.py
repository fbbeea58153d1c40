"""Readers (S1-S4, S10-S12, S18, U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from revscope.schemas import PRODUCTS, PRODUCTS_FULL, REVIEWS

CORRUPT_COLUMN = "_corrupt_record"


def spread(df: DataFrame, min_partitions: int | None) -> DataFrame:
    """gzip files are not splittable (one task per file) and a Parquet file
    is split no finer than its row groups.  When a scan is planned with fewer
    partitions than ``min_partitions``, its rows are spread round-robin so the
    rest of the job is not serialised behind a few huge tasks; a scan that is
    already wide (the normal case on a cluster) is left alone."""
    if not min_partitions or df._jdf.queryExecution().toRdd().getNumPartitions() >= min_partitions:
        return df
    return df.repartition(min_partitions)


def read_reviews(
    spark: SparkSession, path: str, schema: StructType = REVIEWS, min_partitions: int | None = None
) -> DataFrame:
    """Review records from JSON lines (plain or .gz) with a declared schema (S1):
    no inference pass over the input."""
    return spread(spark.read.schema(schema).json(path), min_partitions)


def read_products(
    spark: SparkSession, path: str, schema: StructType = PRODUCTS, min_partitions: int | None = None
) -> DataFrame:
    """Product metadata from JSON lines with a declared schema, 9 or 16 fields."""
    return spread(spark.read.schema(schema).json(path), min_partitions)


def read_products_tolerant(
    spark: SparkSession, path: str, schema: StructType = PRODUCTS_FULL, infer: bool = False
) -> DataFrame:
    """PERMISSIVE read (S3): lines that do not parse keep their raw text in
    ``_corrupt_record`` and NULL fields instead of failing the job.

    By default the declared schema is used (no inference pass over the
    input; fields absent from it are ignored, so malformed or duplicated
    keys in extra fields cannot break the read).  ``infer=True`` first lets
    Spark infer the schema and falls back to the declared one when inference
    fails, e.g. on keys that collide case-insensitively."""
    reader = (
        spark.read.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", "false")
    )
    if infer:
        try:
            inferred = reader.json(path)
            inferred.schema  # forces inference and the duplicate-column check
            return inferred
        except Exception:  # noqa: BLE001 - fall back to the declared schema
            pass
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    return reader.schema(with_corrupt).json(path)


def read_products_variant(spark: SparkSession, path: str, schema: StructType = PRODUCTS_FULL) -> DataFrame:
    """Tolerant read through VARIANT (S3): one pass, no inference, nothing lost.

    Each line is parsed once to a variant, whose fields are picked by exact name:
    - a declared field has its declared type, or NULL where the value does not
      fit it (a number where text is declared becomes text);
    - all other fields are kept as text in the map ``undeclared``, JSON for
      objects and arrays, also names that differ from a declared one only in case,
      which a schema of columns cannot hold;
    - a line that is no JSON object (broken, a bare value, one with a name twice)
      keeps its raw text in ``_corrupt_record``; its other columns are NULL.
    Blank lines are no records."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    fields = F.expr("try_variant_get(record, '$', 'map<string,variant>')")
    parsed = lines.select("value", F.try_parse_json("value").alias("record")).withColumn("__fields", fields)
    declared = [f"try_variant_get(record, '$.{f.name}', '{f.dataType.simpleString()}') AS `{f.name}`" for f in schema.fields]
    others = F.map_filter("__fields", lambda k, v: ~k.isin([f.name for f in schema.fields]))
    text = F.transform_values(others, lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    corrupt = F.when(F.col("__fields").isNull(), F.col("value"))
    return parsed.select(*[F.expr(e) for e in declared], text.alias("undeclared"), corrupt.alias(CORRUPT_COLUMN))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names of the first line of a headered CSV input."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns


def read_feature_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A published, headered CSV table with a declared schema (S10).  Columns
    are matched by the header's names, whatever their order; a declared column
    that the header lacks is an error, and so is a file with another header.
    Quotes inside fields are doubled (RFC 4180), so the escape character is '"'."""
    types = {f.name: f for f in schema.fields}
    header = csv_header(spark, path)
    if missing := [n for n in types if n not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = StructType([types.get(n, StructField(n, StringType(), True)) for n in header])
    return (
        spark.read.schema(declared)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
        .select(*types)
    )


def stage_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-string staging read (S11): every column text, blank cells NULL;
    columns are matched by the header's names."""
    header = csv_header(spark, path)
    if missing := [n for n in columns if n not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = StructType([StructField(c, StringType(), True) for c in header])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .csv(path)
        .select(*columns)
    )


def promote_staged(staged: DataFrame, schema: StructType) -> DataFrame:
    """Typed promotion of a staged table (S12).  Whole numbers written as
    '1.0' go through decimal first; text that is not a number ('.', 'n/a')
    becomes NULL instead of failing the load (try_cast under ANSI)."""
    cols = []
    for field in schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (IntegerType, LongType)):
            c = c.try_cast("decimal(38,4)").cast(field.dataType)
        elif isinstance(field.dataType, StringType):
            pass
        else:
            c = c.try_cast(field.dataType)
        cols.append(c.alias(field.name))
    return staged.select(*cols)


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of several Parquet inputs by column name (U1); columns missing
    in some inputs are filled with NULL.  One directory read already unions
    all of its part files."""
    frames = [spark.read.parquet(p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


concat_parts = read_parts


def input_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files under ``path`` with their sizes (S18).  The ``binaryFile`` source
    prunes the content column, so only file metadata is listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified")
    )


def input_totals(files: DataFrame) -> DataFrame:
    """File count and total size of an input listing."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size_bytes").alias("total_bytes"),
        F.round(F.sum("size_bytes") / (1024 ** 3), 2).alias("total_gb"),
    )


__all__ = [
    "read_reviews",
    "read_products",
    "read_products_tolerant",
    "read_products_variant",
    "read_feature_csv",
    "stage_strings",
    "promote_staged",
    "read_parts",
    "concat_parts",
    "input_files",
    "input_totals",
]
