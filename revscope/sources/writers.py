"""Writers and table management."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revscope.schemas import WAREHOUSE_DECIMALS

# ---- fixed values: distribution and sort keys of the published tables ----
TABLE_LAYOUT = {
    "sentiment_trends": {"bucket_by": "store", "sort_by": ["year_month"]},
    "competitive_analysis": {"bucket_by": "store", "sort_by": ["parent_asin"]},
    "success_prediction": {"bucket_by": "store", "sort_by": ["success_score"]},
    "review_velocity": {"bucket_by": "parent_asin", "sort_by": ["year_month"]},
}
# ---- end of fixed values ----

#: A layout for questions that join tables by product: all that have products are dealt by product.
PRODUCT_LAYOUT = {
    "sentiment_trends": TABLE_LAYOUT["sentiment_trends"],
    "competitive_analysis": {"bucket_by": "parent_asin", "sort_by": ["parent_asin"]},
    "success_prediction": {"bucket_by": "parent_asin", "sort_by": ["parent_asin"]},
    "review_velocity": {"bucket_by": "parent_asin", "sort_by": ["parent_asin", "year_month"]},
}


def write_feature(df: DataFrame, path: str, name: str = "rows") -> int:
    """Overwrite one Parquet table (S5) and return its row count, measured
    while writing (``observe``) instead of by a second job."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def write_all(features: dict[str, DataFrame], base: str) -> dict[str, int]:
    """Write each table under ``base/<name>`` (S6); returns row counts."""
    return {name: write_feature(df, f"{base.rstrip('/')}/{name}", name) for name, df in features.items()}


def export_csv(spark: SparkSession, src: str, dst: str, single_file: bool = False) -> int:
    """Parquet directory -> headered CSV (S7).  Every part file of ``src`` is
    read by the directory scan; the write is parallel unless ``single_file``
    is requested (one task: only for small published tables).  Dates are
    written as yyyy-MM-dd text.  Returns the exported row count."""
    return export_measured(spark, src, dst, {}, single_file)[0]


def export_measured(spark: SparkSession, src: str, dst: str, measures: dict[str, Column], single_file: bool = False) -> tuple[int, dict[str, float | None]]:
    """``export_csv``, and ``measures`` (aggregates by name) of the rows, observed while they are written."""
    df = spark.read.parquet(src)
    if single_file:
        df = df.coalesce(1)
    obs = Observation("export")
    values = [value.cast("double").alias(f"measure_{i}") for i, value in enumerate(measures.values())]
    (
        df.observe(obs, F.count(F.lit(1)).alias("rows"), *values)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(dst)
    )
    got = obs.get
    return int(got["rows"]), {name: got[f"measure_{i}"] for i, name in enumerate(measures)}


def export_all_csv(
    spark: SparkSession, src_base: str, dst_base: str, tables: list[str], single_file: bool = False, measures: dict[str, dict[str, Column]] | None = None
) -> DataFrame:
    """S7 for several tables; a status row per table (S8), with its ``measures`` observed while writing."""
    rows = []
    for name in tables:
        try:
            n, found = export_measured(spark, f"{src_base.rstrip('/')}/{name}", f"{dst_base.rstrip('/')}/{name}", (measures or {}).get(name, {}), single_file)
            rows.append((name, n, "OK", None, found))
        except Exception as exc:  # noqa: BLE001 - the summary reports the failure
            rows.append((name, None, "FAILED", str(exc), None))
    return spark.createDataFrame(rows, "table_name string, rows long, status string, error string, measures map<string,double>")


def export_sample_csv(df: DataFrame, path: str, n: int = 1000, order_by: list[str] | None = None) -> None:
    """The first ``n`` rows (in ``order_by`` order) as one headered CSV."""
    keys = order_by or df.columns
    (
        df.orderBy(*[F.asc_nulls_first(k) for k in keys])
        .limit(n)
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def to_warehouse_types(df: DataFrame) -> DataFrame:
    """Narrow doubles to the published DECIMAL(10,2)/(10,3) and counts to INT."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in WAREHOUSE_DECIMALS:
            c = c.cast(WAREHOUSE_DECIMALS[field.name])
        elif field.dataType.simpleString() == "bigint":
            c = c.cast("int")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def create_feature_table(
    df: DataFrame, name: str, buckets: int = 16, layout: dict | None = None, path: str | None = None
) -> None:
    """Typed table with a distribution and a sort key (S13): bucketing on the
    distribution key co-locates later joins/aggregations on it without a
    shuffle; sorting inside buckets gives min/max skipping on the sort key."""
    spec = layout or TABLE_LAYOUT[name]
    writer = to_warehouse_types(df).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, spec["bucket_by"]).sortBy(*spec["sort_by"])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_feature_tables(
    features: dict[str, DataFrame], buckets: int = 16, layout: dict | None = None, base_path: str | None = None
) -> list[str]:
    """S13 for all published tables: ``{name: DataFrame}`` -> typed, bucketed tables."""
    for name, df in features.items():
        path = f"{base_path.rstrip('/')}/{name}" if base_path else None
        create_feature_table(df, name, buckets, (layout or TABLE_LAYOUT).get(name), path)
    return list(features)


def external_table(spark: SparkSession, name: str, path: str, temporary: bool = True) -> DataFrame:
    """A table over existing Parquet files."""
    if temporary:
        df = spark.read.parquet(path)
        df.createOrReplaceTempView(name)
        return df
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def replace_table(spark: SparkSession, name: str, df: DataFrame, temporary: bool = True) -> None:
    """Drop and re-create a table from ``df``."""
    if temporary:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


# ---- versioned tables: a table is a folder of versions and a pointer to one of them ----
POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that the table's pointer names; None if there is no table yet."""
    place, fs = _fs(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def replace_version(spark: SparkSession, path: str, df: DataFrame, keep: int = 2, partition_by: list[str] | None = None) -> str:
    """Replace the table at ``path`` as a whole (S15, S14); returns the new version.

    The rows are written to a folder of their own and the pointer is switched last,
    by a rename: a reader gets the old version or the new one, never a mixture, a
    write that fails leaves the old one as it is, and ``df`` may read the table
    itself.  Readers that opened a version keep it until ``keep`` newer ones exist;
    what failed writes left goes with the older versions."""
    if keep < 1:
        raise ValueError("one version must stay")
    path = path.rstrip("/")
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}")
    fresh, fs = _fs(spark, f"{path}/{POINTER}-{version}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(version, "utf-8"))
    stream.close()
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = files.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    overwrite[0] = files.Options.Rename.OVERWRITE
    context.rename(fresh, files.Path(f"{path}/{POINTER}"), overwrite)
    versions = sorted((s.getPath().getName() for s in fs.listStatus(files.Path(path)) if s.isDirectory()), reverse=True)
    complete = [v for v in versions if v.startswith("v") and fs.exists(files.Path(f"{path}/{v}/_SUCCESS"))]
    oldest = complete[:keep][-1]
    for v in versions:
        if v.startswith("v") and v < oldest:
            fs.delete(files.Path(f"{path}/{v}"), True)
    return version


def open_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The table's current version, or the one named, as a DataFrame that stays on it."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{version}")
