"""Intermediate tables of a query (M1): written once to the shared folder, read by what follows.

A query that joins, counts and ranks the same reviews would shuffle their source
for each of these, and all shuffle files would lie on the disks until the query
ends.  Staged, the source is shuffled once, and the files of that go as soon as the
table is written.
"""

from __future__ import annotations

import atexit
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from revscope.session import ensure_checkpoint_dir

#: Deletes the shuffle files of a job at its end; they go with the driver's garbage otherwise.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
@contextmanager
def _shuffles_dropped(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Stage:
    """``stage(df, label)``: ``df`` written to the session's checkpoint folder and read back.  A table goes
    when it is dropped, or when Python ends."""

    def __init__(self) -> None:
        self.tables: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        spark = df.sparkSession
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/revscope-{label}-{uuid.uuid4().hex[:12]}"
        with _shuffles_dropped(spark):
            df.write.option("compression", "zstd").parquet(folder)
        kept = spark.read.schema(df.schema).parquet(folder)
        self.tables.append((kept, folder))
        return kept

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing is still to read."""
        for kept, folder in [t for t in self.tables if t[0] is df]:
            delete(kept.sparkSession, folder)
            self.tables.remove((kept, folder))

    def close(self) -> None:
        for kept, folder in self.tables:
            context = kept.sparkSession.sparkContext
            if context._jsc is not None and not context._jsc.sc().isStopped():
                delete(kept.sparkSession, folder)
        self.tables.clear()


staged = Stage()
atexit.register(staged.close)
