"""Windowed counts, trend state and alerts on streams.

Windows are closed by the watermark and then appended once; state is kept for open
windows and for the latest window of each key only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.operators.windows import time_stamp, window_count

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Events with a watermark ``delay`` behind the newest one."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_window_count(
    events: DataFrame,
    ts: str,
    length: str,
    delay: str,
    *keys: str,
    slide: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda events: events,
) -> DataFrame:
    """``window_count`` of a stream: every closed window once.

    ``prepare`` may drop or extend events; all of them, also those it drops, move the clock.
    """
    return window_count(prepare(event_time(events, ts, delay)), ts, length, *keys, slide=slide)


class TrendState(StatefulProcessor):
    """Keeps the latest window of a key and fills silent windows up to the watermark."""

    def __init__(self, length: timedelta):
        self.length = int(length.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "window_end bigint, current bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # Several windows of a key may close at once and arrive in several chunks.
        closed = pd.concat(list(rows))[["end_ms", "n"]].astype("int64").sort_values("end_ms")
        yield self._advance(key, closed.itertuples(index=False), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._advance(key, (), timerValues)

    def _advance(self, key, closed, timer_values) -> pd.DataFrame:
        known = self.latest.get() if self.latest.exists() else None
        out = []

        def step(end: int, current: int) -> tuple[int, int]:
            out.append((key[0], end, current, known[1] if known else 0))
            return end, current

        for end, n in closed:
            while known and known[0] + self.length < end:
                known = step(known[0] + self.length, 0)
            known = step(int(end), int(n))
        while known and known[0] + self.length <= timer_values.getCurrentWatermarkInMs():
            known = step(known[0] + self.length, 0)
        if known:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(known[0] + self.length)
            self.latest.update(known)
        return pd.DataFrame(out, columns=["key", "end_ms", "current", "previous"])

    def close(self) -> None:
        pass


def stream_state_history(counts: DataFrame, key: str, length: timedelta) -> DataFrame:
    """``window_state_history`` of a stream of closed window counts; ``drain`` sets the state store
    that this needs, a stream that is started otherwise has to set it itself."""
    history = (
        counts.select(
            F.col(key).alias("key"), F.unix_millis("window_end").alias("end_ms"), "n"
        )
        .groupBy("key")
        .transformWithStateInPandas(
            statefulProcessor=TrendState(length),
            outputStructType="key string, end_ms bigint, current bigint, previous bigint",
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    end = F.timestamp_millis("end_ms")
    return history.select(
        F.col("key").alias(key),
        (end - F.make_dt_interval(secs=F.lit(length.total_seconds()))).alias("window_start"),
        end.alias("window_end"),
        time_stamp(end).alias("time_stamp"),
        "current",
        "previous",
    )


def stream_with_silent_windows(counts: DataFrame, length: timedelta, *keys: str) -> DataFrame:
    """Closed window counts of a stream with windows without events, count 0, added.

    The windows of a key, or all windows where there is none, run from the first to the watermark:
    a timer in event time stands at the end of the next window and reports it empty when nothing
    else has closed it.
    """
    # Keys travel as one text and come back as they were.
    rows = counts.withColumn("_key", F.to_json(F.struct(*keys)) if keys else F.lit(""))
    history = stream_state_history(rows, "_key", length)
    kinds = counts.select(*keys).schema
    named = F.from_json("_key", kinds)
    return history.select(
        *[named[k].alias(k) for k in keys], "window_start", "window_end", F.col("current").alias("n")
    )


def write_windows(closed: DataFrame, path: str, checkpoint: str, end: str = "window_end"):
    """One folder per closed window, named by its end in milliseconds, exactly once.

    Every micro-batch puts its windows into folders of window and batch. A batch that failed between
    writing and being committed runs again with the same input and number, and then replaces the
    folders it had written.
    """

    def put(rows: DataFrame, batch_id: int) -> None:
        placed = rows.withColumn("window_ms", F.unix_millis(end)).withColumn("batch", F.lit(batch_id))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "window_ms", "batch"
        ).parquet(path)

    return (
        closed.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    )


def write_rows(rows: DataFrame, path: str, checkpoint: str):
    """Stream rows appended to Parquet files."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def counted(rows: DataFrame, name: str, **sums: Column) -> DataFrame:
    """``rows`` of a stream with counters that every micro-batch reports, see ``drain``."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in sums.items()])


def drain(spark: SparkSession, writer) -> list[dict]:
    """Process everything that is there, then stop. Returns the counters of each micro-batch.

    State is kept in no more partitions than there are cores, so that a micro-batch,
    however small, is one wave of tasks. A restarted stream keeps its first number.
    """
    shuffle, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    before = {shuffle: spark.conf.get(shuffle), provider: spark.conf.get(provider)}
    spark.conf.set(shuffle, str(min(int(before[shuffle]), spark.sparkContext.defaultParallelism)))
    spark.conf.set(provider, ROCKSDB)
    try:
        running = writer.trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    running.awaitTermination()
    return [
        {name: row.asDict() for name, row in progress.observedMetrics.items()}
        for progress in running.recentProgress
    ]


def drained(spark: SparkSession, stream: DataFrame, path: str) -> DataFrame:
    """The output of a stream over all input present, as a table."""
    drain(spark, write_rows(stream, f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
