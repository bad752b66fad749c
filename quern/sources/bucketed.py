"""Bucketed tables in the shared folder: joined on their key without a shuffle, pruned by it."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

LAYOUT = "name string, key string, sorted string, buckets int, columns string"


def table_name(path: str) -> str:
    return "quern_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()[:20]


def write_bucketed(
    rows: DataFrame, path: str, buckets: int, key: str, *order: str, dealt: bool = False
) -> None:
    """A Parquet table at ``path``, one file per bucket of ``key``, sorted by ``order`` in each.

    The layout is written beside it, so that any later session can open the table. ``dealt`` says
    that the rows lie by hash of the key already; if not, buckets have a file from every task.
    """
    spark, name = rows.sparkSession, table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # The hash of the exchange is that of the buckets: a task writes one bucket.
    placed = rows if dealt else rows.repartition(buckets, key)
    (
        placed.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(*order)
        .option("path", path)
        .saveAsTable(name)
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    layout = [(name, key, ", ".join(order), buckets, kinds)]
    spark.createDataFrame(layout, LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}_layout")


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, by this or any earlier session."""
    layout = spark.read.schema(LAYOUT).parquet(f"{path}_layout").first()
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY ({layout.key}) "
            f"SORTED BY ({layout.sorted}) INTO {layout.buckets} BUCKETS LOCATION '{path}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)
