"""What all operators of this subpackage share: column picking, shipping, staging.

Inputs are picked by name and renamed, so further columns of the input never
clash with an operator's own; they are simply not read.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``columns`` (new name -> name in ``df``) and nothing else.

    A name is looked up as spelled first and without regard to case second, the
    leftmost winning, so columns that differ only in case are no ambiguity.
    """
    names = df.columns
    flat = df.toDF(*[f"__in{i}" for i in range(len(names))])
    chosen = []
    for new, old in columns.items():
        at = names.index(old) if old in names else [n.lower() for n in names].index(old.lower())
        chosen.append(F.col(f"__in{at}").alias(new))
    return flat.select(*chosen)


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named ``__c0``, ``__c1`` and so on, and those names."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python (once per application)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-ship-"), "llm_operators.zip")
    with zipfile.ZipFile(archive, "w") as out:
        out.write(top / "__init__.py", f"{top.name}/__init__.py")
        for file in sorted((top / "llm").glob("*.py")):
            out.write(file, f"{top.name}/llm/{file.name}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    A local master has no other machine, so there a temporary folder serves
    where the setting is absent; any other master without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


#: Rows of a few ids that may be broadcast.
BROADCAST_ROWS = 1_000_000


def measured(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` (narrow and staged) as a join side: broadcast if counted at no
    more than ``most``, shuffled with the other side beyond that."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows.hint("merge")


class Staging:
    """The staged tables of one job; ``close`` deletes them.

    ``with staging(spark):`` closes at the end of the block, by when results that
    read the tables must be written.  Tables staged outside of any block belong to
    the application and go when Python ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staging:
        _OPEN.append(self)
        return self

    def __exit__(self, *_) -> None:
        self.leave()
        self.close()

    def leave(self) -> None:
        """Tables staged from now on are not this one's."""
        if self in _OPEN:
            _OPEN.remove(self)

    def close(self) -> None:
        while self.paths:
            delete(self.spark, self.paths.pop())


def staging(spark: SparkSession) -> Staging:
    return Staging(spark)


_OPEN: list[Staging] = []
_REST: dict[str, Staging] = {}


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _at_exit() -> None:
    for rest in _REST.values():
        if rest.spark.sparkContext._jsc is not None and not rest.spark.sparkContext._jsc.sc().isStopped():
            rest.close()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and what reads the table twice does not compute it twice.  The table belongs
    to the innermost open ``staging`` block.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    owner = _OPEN[-1] if _OPEN else _REST.setdefault(spark.sparkContext.applicationId, Staging(spark))
    owner.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
