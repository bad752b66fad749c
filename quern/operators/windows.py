"""Windowed event counts in event time. The same functions serve batch and stream input.

Counts are summed per task before the shuffle, so a window or key that holds most of
the events costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.plans.scratch import stored

# Window lengths and alert thresholds.
COUNT_WINDOW = "60 minutes"
TREND_WINDOW = "10 minutes"
MIN_ARRIVALS = 10
GROWTH = 2


def window_count(
    events: DataFrame, ts: str, length: str, *keys: str, slide: str | None = None
) -> DataFrame:
    """``(keys, window_start, window_end, n)``; windows without events give no row."""
    span = F.window(ts, length, slide or length)
    return (
        events.groupBy(span.alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(
            *keys,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n",
        )
    )


def event_count_tumbling(events: DataFrame, ts: str = "ts", length: str = COUNT_WINDOW) -> DataFrame:
    """All events per window, 0 for silent windows between the first and the last."""
    return with_silent_windows(window_count(events, ts, length), length)


def region_event_count(
    located: DataFrame,
    ts: str = "ts",
    region: str = "region",
    length: str = COUNT_WINDOW,
    clock: DataFrame | None = None,
) -> DataFrame:
    """Events per region and window, 0 for silent windows from a region's first one on.

    The last window is that of the last event of ``clock``, by default of ``located``: events
    outside all regions may go on when those inside have ended.
    """
    counts = window_count(located, ts, length, region)
    return with_silent_windows(counts, length, region, last=None if clock is None else _last(clock, ts, length))


def _last(events: DataFrame, ts: str, length: str) -> Column:
    return events.select(F.window(ts, length)["start"].alias("start")).agg(F.max("start")).scalar()


def sliding_window_count(
    events: DataFrame, length: str, slide: str, ts: str = "ts"
) -> DataFrame:
    """Events per window of ``length`` starting every ``slide``."""
    return window_count(events, ts, length, slide=slide)


def _calendar(counts: DataFrame, length: str, keys: tuple[str, ...], last: Column | None = None) -> DataFrame:
    """``(keys, window_start)``: every window from a key's first one to the last of all."""
    if last is None:
        last = counts.agg(F.max("window_start")).scalar()
    windows = F.sequence("first", last, F.expr(f"INTERVAL {length}"))
    first = counts.groupBy(*keys).agg(F.min("window_start").alias("first")).where("first is not null")
    return first.select(*keys, F.explode(windows).alias("window_start"))


def with_silent_windows(counts: DataFrame, length: str, *keys: str, last: Column | None = None) -> DataFrame:
    """Add windows without events, count 0, from a key's first window to the last of all.

    Without keys there is one calendar, from the first window to the last. ``last`` is the start of
    the last window, not before any of ``counts``. Writes the counts when called: they are read for
    the calendar and for the sums.
    """
    counts = stored(counts, "windows")
    silent = _calendar(counts, length, keys, last).withColumn("n", F.lit(0).cast("bigint"))
    window_end = F.col("window_start") + F.expr(f"INTERVAL {length}")
    return (
        counts.select(*keys, "window_start", "n")
        .unionByName(silent)
        .groupBy(*keys, "window_start")
        .agg(F.sum("n").alias("n"))
        .select(*keys, "window_start", window_end.alias("window_end"), "n")
    )


def time_stamp(moment: Column) -> Column:
    """Milliseconds since 1970 with at least eight digits."""
    return F.format_string("%08d", F.unix_millis(moment))


def window_state_history(counts: DataFrame, key: str, length: str) -> DataFrame:
    """``(key, window_start, window_end, time_stamp, current, previous)`` for every window.

    A window without events counts 0, from a key's first window to the last of all. The
    previous count is the one a window length earlier, so counts are also laid one
    window ahead: everything meets in one sum, without an ordered walk along a key.
    """
    counts = stored(counts, "windows")
    step = F.expr(f"INTERVAL {length}")
    last = counts.agg(F.max("window_start")).scalar()
    zero = F.lit(0).cast("bigint")
    here = F.struct(
        F.col("window_start").alias("at"), F.col("n").alias("current"), zero.alias("previous")
    )
    ahead = F.struct(
        (F.col("window_start") + step).alias("at"),
        zero.alias("current"),
        F.col("n").alias("previous"),
    )
    silent = _calendar(counts, length, (key,)).select(
        key, F.col("window_start").alias("at"), zero.alias("current"), zero.alias("previous")
    )
    return (
        counts.select(key, F.inline(F.array(here, ahead)))
        .where(F.col("at") <= last)
        .unionByName(silent)
        .groupBy(key, "at")
        .agg(F.sum("current").alias("current"), F.sum("previous").alias("previous"))
        .select(
            key,
            F.col("at").alias("window_start"),
            (F.col("at") + step).alias("window_end"),
            time_stamp(F.col("at") + step).alias("time_stamp"),
            "current",
            "previous",
        )
    )


def trending_alerts(
    history: DataFrame, minimum: int = MIN_ARRIVALS, growth: float = GROWTH
) -> DataFrame:
    """Windows with at least ``minimum`` events and ``growth`` times those of the window before."""
    return history.where(
        (F.col("current") >= minimum) & (F.col("current") >= growth * F.col("previous"))
    )
