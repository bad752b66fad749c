"""Exact removal of repeated byte strings by suffix arrays over shards.

Windows of ``length`` bytes are dealt to anchors (see ``anchors``); an anchor met once holds
no repeat. The segments of an anchor met again are collapsed to different ones with a count,
and these form a shard, the anchor itself standing as one letter. Shards are sorted by
induced sorting and their permuted common prefixes computed; a window whose prefix in common
with its neighbour covers it whole occurs twice. An anchor with more than ``group_limit``
different segments (a passage shorter than a window in many texts) has its windows counted
by their hashes instead, which needs no group in one place.

Hashes have 64 bits and windows are compared under equal anchors, so 128 bits must agree
where hashes decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.anchors import segments
from quern.llm.hashing import BYTE, of_grams, signed, texts
from quern.llm.suffixes import common_prefixes, suffix_arrays
from quern.llm.tables import columns, field, keyed, merged, ranges, stored, table_schema

ANCHOR, SEPARATOR = b"\xfe", b"\xff"  # bytes of no UTF-8 text
OUT = columns(
    n_bytes="long", n_removed="long", n_spans="long", kept_sha256="string", spans="ranges", kept="binary"
)
ANCHORS = "anchor long, content long, key long, at long, place int, windows int"
SPANS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
OUT_ARROW = to_arrow_type(OUT)
CUT = "anchor long, content long, copies long, segment binary, window long, place int"
FOUND = "anchor long, content long, spans array<struct<low: long, high: long>>"


def _anchors(text_col: str, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for t in texts(field(batch, text_col)):
                s = segments(BYTE[t.data], t.start, t.end, length, gram)
                of = np.searchsorted(t.end, s.start, "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(s.anchor)),
                        pa.array(signed(s.content)),
                        pa.array(keys[t.first + of]),
                        pa.array(s.start - t.start[of]),
                        pa.array(s.place.astype(np.int32)),
                        pa.array(s.count.astype(np.int32)),
                    ],
                    ["anchor", "content", "key", "at", "place", "windows"],
                )

    return run


def _cut_segments(text_col: str, length: int, gram: int):
    """Texts of the wanted segments; of a crowded anchor the hashes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(field(batch, text_col)):
                wanted = batch.column("wanted").slice(t.first, len(t.start)).to_pylist()
                rows: list[tuple] = []
                for low, segments_here in zip(t.start.tolist(), wanted):
                    for w in segments_here:
                        at, n = low + w["at"], w["windows"]
                        data = t.data[at : at + n + length - 1]
                        head = (w["anchor"], w["content"], w["copies"])
                        if w["crowded"]:
                            hashes = signed(of_grams(BYTE[data], length)).tolist()
                            rows += [(*head, None, h, i) for i, h in enumerate(hashes)]
                        else:
                            left, right = data[: w["place"]], data[w["place"] + gram :]
                            rows.append((*head, left.tobytes() + ANCHOR + right.tobytes(), None, None))
                if rows:
                    names = ["anchor", "content", "copies", "segment", "window", "place"]
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                    )

    return run


def _runs(places: np.ndarray) -> list[dict]:
    """Ascending places as ranges."""
    if not len(places):
        return []
    opens = np.flatnonzero(np.diff(places, prepend=places[0] - 2) != 1)
    closes = np.append(opens[1:], len(places)) - 1
    return [{"low": int(places[a]), "high": int(places[b]) + 1} for a, b in zip(opens, closes)]


def repeated_in_shards(shards: list[list[bytes]], width: int) -> list[list[dict]]:
    """For each piece of each shard the ranges of places where a string of ``width`` letters
    begins that also begins elsewhere in the shard."""
    parts = [SEPARATOR.join(pieces) + SEPARATOR for pieces in shards]
    size = np.array([len(p) for p in parts])
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(parts), np.uint8)
    order = suffix_arrays(data, base, size)
    before, common = common_prefixes(data, order, base, width)
    enough = np.flatnonzero(common >= width)
    twice = np.zeros(len(data), bool)
    twice[enough] = True
    twice[before[enough]] = True
    found, at = [], 0
    for piece in (p for pieces in shards for p in pieces):
        inside = max(0, len(piece) - width + 1)
        found.append(_runs(np.flatnonzero(twice[at : at + inside])))
        at += len(piece) + 1
    return found


def _sort_shards(width: int, batch_bytes: int):
    def results(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        shards: list[list[bytes]] = []
        for i, (a, _, piece) in enumerate(rows):
            if not i or rows[i - 1][0] != a:
                shards.append([])
            shards[-1].append(piece)
        found = repeated_in_shards(shards, width)
        hit = [(a, c, f) for (a, c, _), f in zip(rows, found) if f]
        columns = list(zip(*hit)) or [[], [], []]
        kinds = [pa.int64(), pa.int64(), SPANS]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "content", "spans"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("anchor", "content", "segment"))
            for a, c, s in zip(*columns):
                if size >= batch_bytes and rows[-1][0] != a:
                    yield results(rows)
                    rows, size = [], 0
                rows.append((a, c, s))
                size += len(s)
        if rows:
            yield results(rows)

    return run


def _remove(text_col: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found").to_pylist()
            out = []
            for text, spans in zip(field(batch, text_col).to_pylist(), found):
                data = (text or "").encode()
                cut = merged(spans or [])
                kept, at = [], 0
                for low, high in cut.tolist():
                    kept.append(data[at:low])
                    at = high
                rest = b"".join((*kept, data[at:]))
                out.append(
                    {
                        "n_bytes": len(data), "n_removed": len(data) - len(rest), "n_spans": len(cut),
                        "kept_sha256": hashlib.sha256(rest).hexdigest(),
                        "spans": [{"low": a, "high": b} for a, b in cut.tolist()],
                        "kept": rest if keep else None,
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, OUT_ARROW)], ["row", "out"]
            )

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 400,
    group_limit: int = 64,
    batch_bytes: int = 3 << 18,
    keep_bytes: bool = True,
) -> DataFrame:
    """``row`` and ``out``: what remains of each text without bytes covered by a string of
    ``length`` bytes that also starts anywhere else.

    Null and empty texts have no bytes, a text shorter than ``length`` loses none, repeated
    rows are texts like any other and repeat each other. ``kept`` is binary, since a cut can
    fall inside a character. Writes two intermediate tables when called.
    """
    gram = max(1, length // 2)
    rows = keyed(docs, id_col, text_col)
    anchors = stored(rows.mapInArrow(_anchors(text_col, length, gram), ANCHORS), "anchors")
    # A table, so that the join has plain shuffles on both sides and hot keys can be split.
    again = stored(
        anchors.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most"))
        .where("n > 1")
        .select("anchor", (F.col("least") == F.col("most")).alias("alike")),
        "again",
    )
    shared = stored(anchors.join(again, "anchor"), "shared")
    same = shared.where("alike").select(
        "key", ranges(F.col("at"), F.col("at") + F.col("windows") + (length - 1)).alias("span")
    )
    mixed_ = shared.where("not alike")
    kinds = mixed_.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "at", "place", "windows")).alias("one")
    )
    crowded = kinds.groupBy("anchor").agg((F.count("*") > group_limit).alias("crowded"))
    kinds = kinds.join(crowded, "anchor")
    wanted = kinds.groupBy("one.key").agg(
        F.collect_list(
            F.struct("anchor", "content", "copies", "one.at", "one.place", "one.windows", "crowded")
        ).alias("wanted")
    )
    wanted_rows = rows.select("key", F.struct(F.col("row")[text_col].alias(text_col)).alias("row"))
    cut = stored(
        wanted_rows.join(wanted, "key").mapInArrow(_cut_segments(text_col, length, gram), CUT),
        "cut",
    )
    sorted_ = (
        cut.where("segment is not null")
        .select("anchor", "content", "segment")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sort_shards(length - gram + 1, batch_bytes), FOUND)
    )
    counted = cut.where("window is not null")
    twice = counted.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).where("n > 1")
    by_hash = (
        counted.join(twice, ["anchor", "window"])
        .groupBy("anchor", "content")
        .agg(F.collect_list(ranges(F.col("place"), F.col("place") + 1)).alias("spans"))
    )
    whole = kinds.where("copies > 1").select(
        "anchor", "content", F.array(ranges(F.lit(0), F.col("one.windows"))).alias("spans")
    )
    classes = sorted_.unionByName(by_hash).unionByName(whole)
    parts = (
        mixed_.join(classes, ["anchor", "content"])
        .select("key", "at", F.explode("spans").alias("s"))
        .select("key", ranges(F.col("at") + F.col("s.low"), F.col("at") + F.col("s.high") + (length - 1)).alias("span"))
    )
    found = same.unionByName(parts).groupBy("key").agg(F.collect_list("span").alias("found"))
    return (
        rows.join(found, "key", "left")
        .select("row", "found")
        .mapInArrow(_remove(text_col, keep_bytes), table_schema(docs, OUT))
    )
