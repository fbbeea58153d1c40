"""Constraints checked while a table is written, with the rows that fail set apart.

A checked table is one folder with two partitions, written in one pass:
``accepted=true`` holds the rows that meet every constraint, ``accepted=false``
the others, with the names of what they fail in ``failed_checks``.  The counts
come from ``observe`` in the writing job, so checking costs no further scan.

Defined cases: a constraint that is NULL for a row counts as met, as in SQL's
CHECK; a table without rows, or without rows of one kind, reads as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from revscope.sources.readers import promote_staged, stage_strings

FAILED = "failed_checks"


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNotNull() for c in columns}


def within(column: str, low, high) -> dict[str, Column]:
    return {f"{column} out of {low} to {high}": F.col(column).between(low, high)}


def write_checked(df: DataFrame, path: str, checks: dict[str, Column], measures: dict[str, Column] | None = None, evidence: str | None = None, unwritten: tuple = ()) -> dict:
    """Write ``df`` as a checked table; ``checks`` has what must hold, by name.

    Column ``evidence`` is kept for rejected rows only; columns ``unwritten`` serve the checks.
    Returns ``rows``, ``rejected``, ``failed`` (rows by check) and ``measures``
    (further aggregates over the accepted rows' values, by name), all observed while writing."""
    if FAILED in df.columns or "accepted" in df.columns:
        raise ValueError(f"columns {FAILED} and accepted belong to the checked table")
    met = {name: F.coalesce(holds, F.lit(True)) for name, holds in checks.items()}
    names = F.array_compact(F.array(*[F.when(~holds, F.lit(name)) for name, holds in met.items()])) if met else F.array().cast("array<string>")
    judged = df.withColumn(FAILED, names).withColumn("accepted", F.size(FAILED) == 0).drop(*unwritten)
    if evidence:
        judged = judged.withColumn(evidence, F.when(~F.col("accepted"), F.col(evidence)))
    counts = [F.count_if(F.array_contains(FAILED, name)).alias(f"failed_{i}") for i, name in enumerate(met)]
    more = [value.alias(f"measure_{i}") for i, value in enumerate((measures or {}).values())]
    seen = Observation()
    observed = judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("accepted")).alias("rejected"), *counts, *more)
    observed.write.mode("overwrite").partitionBy("accepted").parquet(path)
    got = seen.get
    return {
        "rows": got["rows"],
        "rejected": got["rejected"],
        "failed": {name: got[f"failed_{i}"] for i, name in enumerate(met)},
        "measures": {name: got[f"measure_{i}"] for i, name in enumerate(measures or {})},
    }


def accepted_only(aggregate: Callable[[Column], Column], column: str) -> Column:
    """``aggregate`` of ``column`` over accepted rows, as a measure."""
    return aggregate(F.when(F.col("accepted"), F.col(column)))


def _kind(spark: SparkSession, path: str, schema: StructType, accepted: bool) -> DataFrame:
    """Rows of one partition; only its files are opened."""
    whole = StructType([*schema.fields]).add("accepted", "boolean")
    return spark.read.schema(whole).parquet(path).filter(F.col("accepted") == accepted).drop("accepted")


def open_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The accepted rows."""
    return _kind(spark, path, schema, True)


def quarantined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rejected rows, with what they fail."""
    return _kind(spark, path, StructType([*schema.fields]).add(FAILED, ArrayType(StringType())), False)


def cast_checks(schema: StructType, typed: str, raw: str) -> dict[str, Column]:
    """For structs ``raw`` (text) and ``typed``: text that is there casts to its column's type."""
    return {f"{f.name} is no {f.dataType.simpleString()}": F.col(f"{raw}.{f.name}").isNull() | F.col(f"{typed}.{f.name}").isNotNull() for f in schema.fields}


def cast_faults(staged: DataFrame, schema: StructType) -> DataFrame:
    """How a staged all-text table casts (S11, S12): a row for each column with its rows, blank
    cells and cells whose text is no value of the type, from one aggregate pass."""
    both = _with_text(staged, schema)
    checks = list(cast_checks(schema, "typed", "raw").values())
    wide = both.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"raw.{f.name}").isNull()).alias(f"blank_{i}") for i, f in enumerate(schema.fields)],
        *[F.count_if(~holds).alias(f"faulty_{i}") for i, holds in enumerate(checks)],
    )
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col("rows").alias("total_rows"), F.col(f"blank_{i}").alias("blank"), F.col(f"faulty_{i}").alias("faulty")) for i, f in enumerate(schema.fields)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _with_text(staged: DataFrame, schema: StructType) -> DataFrame:
    """Structs ``typed`` and ``raw`` (the text as read) of each row."""
    raw = staged.select(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])
    one = promote_staged(raw.select("*", F.struct(*[F.col(f.name) for f in schema.fields]).alias("__raw")), StructType([*schema.fields]).add("__raw", raw.schema))
    return one.select(F.struct(*[F.col(f.name) for f in schema.fields]).alias("typed"), F.col("__raw").alias("raw"))


def load_staged(spark: SparkSession, csv_path: str, target: str, schema: StructType, checks: dict[str, Column] | None = None) -> dict:
    """The staged load as one flow: headered CSV read as text (S11), promoted to ``schema`` (S12),
    checked and written (one pass), with the rows whose text does not cast, or that fail one of
    ``checks`` (of the typed columns), set apart together with their text (column ``raw``).

    Returns the report of ``write_checked``; ``open_checked`` and ``quarantined_load`` read the two kinds."""
    both = _with_text(stage_strings(spark, csv_path, schema.names), schema)
    judged = cast_checks(schema, "typed", "raw") | (checks or {})
    return write_checked(both.select("typed.*", "typed", "raw"), target, judged, evidence="raw", unwritten=("typed",))


def quarantined_load(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that a staged load set apart: typed columns, their text (``raw``) and what they fail."""
    text = StructType()
    for f in schema.fields:
        text = text.add(f.name, StringType())
    return quarantined(spark, path, StructType([*schema.fields]).add("raw", text))


__all__ = ["accepted_only", "cast_checks", "cast_faults", "load_staged", "not_null", "open_checked", "quarantined", "quarantined_load", "within", "write_checked"]
