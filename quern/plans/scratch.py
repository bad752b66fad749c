"""The folder for intermediate tables, stream checkpoints and lineage cuts.

A cluster names a shared folder in ``spark.checkpoint.dir``; everything that has
to outlive a lost executor goes below it. Only where the setting is absent (a
local session, such as in tests) a temporary folder is made.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quern-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_open: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """Removes at its end the folders that ``fresh_path`` has named within it, and no others.

    Gives the list of these paths; one that is taken out of it stays. Whatever is computed from the
    others has to be written before the end.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.remove(made)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs within it are removed as soon as it has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(rows: DataFrame, label: str = "stored") -> DataFrame:
    """``rows`` written once as a table in the shared folder, for plans that read it repeatedly.

    The files outlive any executor, are read by column, and tell the planner their size. The shuffle
    files behind them are of no more use and go at once, so no two steps have theirs on disk together.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, label)
    with _shuffles_removed(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows`` saved below the shared folder in the partitioning they have."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)
