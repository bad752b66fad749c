"""What a path is, on whatever file system it lies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Compressed columns of numbers grow about tenfold in the rows of a sort or a hash table.
PART_BYTES = 16 * 1024 * 1024


def _status(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(jvm_path) if files.exists(jvm_path) else None


def exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def is_folder(spark: SparkSession, path: str) -> bool:
    status = _status(spark, path)
    return status is not None and status.isDirectory()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of one file."""
    return _status(spark, path).getLen()


def shuffle_parts(rows: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Partitions for a shuffle of all ``rows`` of a table: one per ``part_bytes`` of its files, and
    no fewer than the session has for any shuffle."""
    spark = rows.sparkSession
    total = sum(size(spark, file) for file in rows.inputFiles())
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
