"""Session entry (E1) and the few session-level settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library expects.  AQE re-plans joins and
# coalesces shuffle partitions at run time; the session time zone is pinned
# because review dates are derived from epoch milliseconds.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def session(app: str = "revscope", conf: dict | None = None, master: str | None = None) -> SparkSession:
    """Build (or get) a session with the library defaults plus ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return ensure_utc(spark)


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (day and month edges of reviews)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Shuffled bytes that AQE joins into one task at most.  Review keys compress well: tasks of
#: 61 MB took up to 722 MB of memory in their sorts and hash aggregates.
PARTITION_BYTES = "16m"


def ensure_partition_size(spark: SparkSession) -> SparkSession:
    """Bound the shuffled bytes of one task, unless the session states its own bound."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(key, None) in (None, "64MB", "67108864b"):
        spark.conf.set(key, PARTITION_BYTES)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``,
    else the context's checkpoint folder.  Where neither is named, a local
    master (one machine) gets a temporary folder; any other is refused, since
    a folder of one machine would lose or hide the others' files."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="revscope-checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
