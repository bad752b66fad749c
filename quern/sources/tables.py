"""Relations: Parquet files and delimited text files with a given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from quern.sources.files import exists


def table_path(spark: SparkSession, folder: str, name: str) -> str:
    """``<folder>/<name>.parquet`` where it exists, else ``<folder>/<name>``."""
    path = f"{folder.rstrip('/')}/{name}"
    return f"{path}.parquet" if exists(spark, f"{path}.parquet") else path


def scan_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the folder, a file or a directory of files."""
    return spark.read.parquet(table_path(spark, folder, name))


def scan_delimited(
    spark: SparkSession, folder: str, name: str, schema: StructType, delimiter: str = "|"
) -> DataFrame:
    """``<folder>/<name>.tbl``, one row per line.

    Lines are split plainly: quotes and backslashes are letters like any other, and an
    empty field of a string column is the empty string. A delimiter after the last field
    makes one more, empty field, which is dropped. Any other line that does not fit the
    schema fails the job.
    """
    return (
        spark.read.schema(StructType([*schema.fields, StructField("_end", StringType())]))
        .option("sep", delimiter)
        .option("quote", "")
        .option("escape", "")
        .option("emptyValue", "")
        .option("nullValue", "\u0000")
        .option("mode", "FAILFAST")
        .csv(f"{folder.rstrip('/')}/{name}.tbl")
        .drop("_end")
    )
