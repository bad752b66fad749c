"""Windowed counts and trend state: hand-made streams, stream = batch, restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quern.functions.regions import TAXI_SITES, region_assign, taxi_point
from quern.operators import windows
from quern.streaming import replay
from quern.streaming import windows as streams

T0 = datetime(2024, 1, 1)


def minute(m):
    return T0 + timedelta(minutes=m)


# Key a: 2 events, a silent window, 5 events; key b starts later and falls silent.
EVENTS = (
    [("a", minute(m)) for m in (1, 9)]
    + [("b", minute(m)) for m in (12, 13, 14)]
    + [("a", minute(m)) for m in (20, 21, 22, 23, 29)]
    + [("a", minute(m)) for m in (31, 45)]
)
SCHEMA = "key string, ts timestamp"


def history_rows(frame):
    columns = ("key", "window_end", "current", "previous")
    return {tuple(r[c] for c in columns) for r in frame.collect()}


EXPECTED = {
    ("a", minute(10), 2, 0), ("a", minute(20), 0, 2), ("a", minute(30), 5, 0),
    ("a", minute(40), 1, 5), ("a", minute(50), 1, 1),
    ("b", minute(20), 3, 0), ("b", minute(30), 0, 3), ("b", minute(40), 0, 0),
    ("b", minute(50), 0, 0),
}


def test_batch_history(spark):
    events = spark.createDataFrame(EVENTS, SCHEMA)
    counts = windows.window_count(events, "ts", "10 minutes", "key")
    history = windows.window_state_history(counts, "key", "10 minutes")
    assert history_rows(history) == EXPECTED
    stamp = history.where("key = 'b'").orderBy("window_end").first().time_stamp
    assert stamp == str(int((minute(20) - datetime(1970, 1, 1)).total_seconds() * 1000))
    alerts = windows.trending_alerts(history, minimum=3)
    assert {r[:2] for r in history_rows(alerts)} == {("a", minute(30)), ("b", minute(20))}


def test_default_alert_thresholds(spark):
    rows = [(9, 0), (10, 5), (10, 6), (30, 15), (31, 16)]
    history = spark.createDataFrame(rows, "current bigint, previous bigint")
    got = sorted(map(tuple, windows.trending_alerts(history).collect()))
    assert got == [(10, 5), (30, 15)]


def land(spark, rows, path):
    replay.land(spark.createDataFrame(rows, SCHEMA), path, "ts")


def stream_history(spark, folder):
    stream = replay.stream_files(spark, folder, SCHEMA)
    counts = streams.stream_window_count(stream, "ts", "10 minutes", "0 minutes", "key")
    return streams.stream_state_history(counts, "key", timedelta(minutes=10))


def test_stream_history_over_several_batches_and_a_restart(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    # One file per batch; the second batch of files comes after a stop.
    land(spark, EVENTS[:5], folder)
    land(spark, EVENTS[5:10], folder)
    first = history_rows(streams.drained(spark, stream_history(spark, folder), out))
    land(spark, EVENTS[10:], folder)
    # A far event closes every window before it, silent ones too; its own stays open.
    land(spark, [("a", minute(51)), ("z", minute(51))], folder)
    # Too late: its window was closed by the watermark and is not reopened.
    land(spark, [("a", minute(2))], folder)
    got = history_rows(streams.drained(spark, stream_history(spark, folder), out))
    assert first < got
    assert got == EXPECTED


def test_stream_window_folders(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, EVENTS, folder)
    stream = replay.stream_files(spark, folder, SCHEMA)
    closed = streams.stream_window_count(stream, "ts", "10 minutes", "0 minutes")
    streams.drain(spark, streams.write_windows(closed, str(tmp_path / "out"), str(tmp_path / "check")))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.n for r in read.collect()) == [1, 2, 3, 5]
    stamps = {int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("window_ms=*")}
    epoch = datetime(1970, 1, 1)
    assert stamps == {
        int((minute(m) - epoch).total_seconds() * 1000) for m in (10, 20, 30, 40)
    }


def test_windows_are_written_once_when_a_batch_fails_before_its_commit(spark, tmp_path):
    """The batch has written its folders, the stream dies before it counts as done."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    land(spark, EVENTS[:5], folder)
    land(spark, EVENTS[5:], folder)
    land(spark, [("z", minute(51))], folder)
    writes = []

    def writer(fails):
        stream = replay.stream_files(spark, folder, SCHEMA)
        closed = streams.stream_window_count(stream, "ts", "10 minutes", "0 minutes", "key")

        class Dying:
            """A stream writer whose first batch with rows fails after it has written them."""

            def __init__(self, frame):
                self.writeStream, self.frame = self, frame

            def outputMode(self, mode):
                self.real = self.frame.writeStream.outputMode(mode)
                return self

            def foreachBatch(self, put):
                def once(rows, batch_id):
                    put(rows, batch_id)
                    writes.append(batch_id)
                    if rows.count():
                        raise OSError("lost before the commit")

                return self.real.foreachBatch(once if fails else put)

        return streams.write_windows(Dying(closed), out, check)

    for _ in range(2):
        with pytest.raises(Exception, match="lost before the commit"):
            streams.drain(spark, writer(True))
    assert len(writes) > len(set(writes))  # the same batch was written again
    streams.drain(spark, writer(False))
    streams.drain(spark, writer(False))
    got = sorted((r.window_ms, r.key, r.n) for r in spark.read.parquet(out).collect())
    batch = windows.window_count(spark.createDataFrame(EVENTS, SCHEMA), "ts", "10 minutes", "key")
    wanted = batch.select(F.unix_millis("window_end").alias("ms"), "key", "n").collect()
    assert got == sorted(map(tuple, wanted))


SPARSE = [("a", minute(1)), ("b", minute(35)), ("b", minute(38)), ("a", minute(72))]


def filled(frame, *keys):
    return {tuple(r[c] for c in (*keys, "window_start", "window_end", "n")) for r in frame.collect()}


def test_silent_windows_in_batch_and_stream(spark, tmp_path):
    events = spark.createDataFrame(SPARSE, SCHEMA)
    counts = {0: 1, 30: 2, 70: 1}
    wanted = {(minute(m), minute(m + 10), counts.get(m, 0)) for m in range(0, 80, 10)}
    assert filled(windows.event_count_tumbling(events, "ts", "10 minutes")) == wanted
    of_b = {("b", minute(m), minute(m + 10), 2 if m == 30 else 0) for m in range(30, 80, 10)}
    of_a = {("a", minute(m), minute(m + 10), 1 if m in (0, 70) else 0) for m in range(0, 80, 10)}
    assert filled(windows.region_event_count(events, "ts", "key", "10 minutes"), "key") == of_a | of_b
    only_b = events.where("key = 'b'")
    assert len(filled(windows.region_event_count(only_b, "ts", "key", "10 minutes"), "key")) == 1
    assert filled(windows.region_event_count(only_b, "ts", "key", "10 minutes", clock=events), "key") == of_b
    assert windows.event_count_tumbling(events.where("false"), "ts", "10 minutes").count() == 0

    for i, row in enumerate([*SPARSE, ("z", minute(80))]):
        land(spark, [row], str(tmp_path / "in"))
        if i in (1, 4):  # a restart in the silence
            for keys, out in (((), "all"), (("key",), "keyed")):
                stream = replay.stream_files(spark, str(tmp_path / "in"), SCHEMA)
                counted = streams.stream_window_count(stream, "ts", "10 minutes", "0 minutes", *keys)
                rows = streams.stream_with_silent_windows(counted, timedelta(minutes=10), *keys)
                found = streams.drained(spark, rows, str(tmp_path / out))
                if i == 4:
                    assert filled(found, *keys) == (of_a | of_b if keys else wanted)
                    assert found.schema["n"].dataType.typeName() == "long"


def test_replay_needs_a_folder(spark, tmp_path):
    file = tmp_path / "part-0"
    file.write_text("x")
    for path in (file, tmp_path / "absent"):
        with pytest.raises(ValueError):
            replay.stream_files(spark, str(path), "value string", "text")


def test_replay_takes_part_files_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-00001").write_text("x\ny\n")
    (tmp_path / "in" / "part-00002").write_text("z\n")
    (tmp_path / "in" / "other").write_text("no\n")
    stream = replay.stream_files(spark, str(tmp_path / "in"), "value string", "text")
    seen = streams.counted(stream, "lines", longest=F.max(F.length("value")))
    out = str(tmp_path / "out")
    counters = streams.drain(spark, streams.write_rows(seen, out, str(tmp_path / "check")))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]
    assert sum(c["lines"]["rows"] for c in counters if "lines" in c) == 3


def test_sliding_windows(spark):
    events = spark.createDataFrame(EVENTS, SCHEMA)
    got = windows.sliding_window_count(events, "20 minutes", "10 minutes")
    counts = {r.window_start: r.n for r in got.collect()}
    for start, n in counts.items():
        assert n == sum(start <= t < start + timedelta(minutes=20) for _, t in EVENTS)
    assert sum(counts.values()) == 2 * len(EVENTS)


def test_taxi_regions(spark):
    def record(kind, x, y):
        fields = ["0"] * 12
        fields[0] = kind
        fields[8 if kind == "green" else 10], fields[9 if kind == "green" else 11] = str(x), str(y)
        return (",".join(fields),)

    lines = spark.createDataFrame(
        [
            record("green", -74.014, 40.7145), record("yellow", -74.011, 40.721),
            record("yellow", -74.014, 40.7145), record("green", -73.9, 40.7),
            record("green", -74.013777, 40.7145),
        ],
        "value string",
    )
    x, y = taxi_point(F.split("value", ","))
    got = [r.region for r in region_assign(lines, x, y, TAXI_SITES).collect()]
    assert got == ["goldman", "citigroup", "goldman"]


def test_no_event_is_lost_with_many_files_per_period_and_restarts(spark, tmp_path):
    rows = [(f"k{i % 3}", T0 + timedelta(seconds=37 * i)) for i in range(3000)]
    events = spark.createDataFrame(rows, SCHEMA)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    closing = replay.closing_event(events, "ts", "10 minutes", "5 minutes")
    for part in [*replay.time_slices(events, "ts", 3), closing]:
        part.repartition(8).write.mode("append").parquet(folder)
        stream = replay.stream_files(spark, folder, events.schema, files_per_batch=None)
        counts = streams.stream_window_count(stream, "ts", "10 minutes", "5 minutes", "key")
        found = streams.drained(spark, counts, out)
    batch = windows.window_count(events, "ts", "10 minutes", "key")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.select(found.columns).collect()))
    assert found.agg(F.sum("n")).first()[0] == len(rows)
