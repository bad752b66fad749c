"""File streams: replaying part files, and landing a table as part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.sources.files import is_folder
from quern.sources.tables import table_path


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_batch: int | None = 1,
) -> DataFrame:
    """The ``part-*`` files of a folder as a stream, ``files_per_batch`` at a time.

    Files are taken by age, not by name; operators on the stream go by event time.
    """
    if not is_folder(spark, path):
        raise ValueError(f"{path} is not a folder of part files")
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", "part-*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored Parquet table as a stream; all files present make up one batch.

    The files of a table are in no order of time. Taken together they cannot overtake
    each other, so no event is late.
    """
    path = table_path(spark, folder, name)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    parent, file = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", file).parquet(parent)


def land_slices(events: DataFrame, path: str, ts: str, slices: int) -> None:
    """Append ``events`` to ``path`` in ``slices`` steps of equal time, oldest first.

    Later slices get younger files, so a replay meets them in order of event time.
    """
    for part in time_slices(events, ts, slices):
        land(part, path, ts)


def closing_event(events: DataFrame, ts: str, length: str, delay: str) -> DataFrame:
    """One event of no content, late enough to close every window of ``events``.

    It comes ``delay`` after the end of the last window. Text columns are empty, all others
    null; its own window stays open and is never reported.
    """
    last = events.agg(F.max(ts).cast("timestamp").alias("last"))
    moment = F.window("last", length)["end"] + F.expr(f"INTERVAL {delay}")
    return last.select(
        *[
            (moment if f.name == ts else F.lit("") if f.dataType.typeName() == "string" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in events.schema.fields
        ]
    )


def land(events: DataFrame, path: str, ts: str) -> None:
    events.repartitionByRange(ts).sortWithinPartitions(ts).write.mode("append").parquet(path)


def time_slices(events: DataFrame, ts: str, slices: int) -> list[DataFrame]:
    """The table cut into ``slices`` consecutive periods of equal length."""
    first, last = events.agg(F.min(ts), F.max(ts)).first()
    span = (last - first) / slices
    starts = [first + span * i for i in range(slices)]
    moment = F.col(ts)
    kind = events.schema[ts].dataType
    parts = []
    for i, start in enumerate(starts):
        inside = F.lit(True) if i == 0 else moment >= F.lit(start).cast(kind)
        if i + 1 < slices:
            inside = inside & (moment < F.lit(starts[i + 1]).cast(kind))
        parts.append(events.where(inside))
    return parts
