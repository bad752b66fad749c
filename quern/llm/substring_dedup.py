"""Removal of repeated word passages by seeds that are extended both ways.

Seeds are winnowed anchors: of every window of ``length`` words the run of ``gram`` words with
the least hash. Documents are joined on seeds met more than once. A seed is extended left and
right to all windows it stands for: where all places of a seed have the same surroundings, at
once; where they differ, window by window, each looking for its earliest place. Windows that
an earlier place already has make up the repeats; touching ones form one maximal repeat.

Only the different surroundings of a seed are extended, never pairs of places, so a passage
in very many documents costs no more than its rows. Words and windows are compared by hashes
of 64 bits, windows under equal seeds (128 bits).
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
from quern.llm.hashing import of_grams, signed, texts, words
from quern.llm.tables import columns, field, keyed, merged, portions, ranges, stored, table_schema

OUT = columns(n_words="long", n_removed="long", kept_sha256="string", spans="ranges", kept="string")
OUT_ARROW = to_arrow_type(OUT)
SEEDS = "seed long, content long, key long, at int, windows int"
WINDOWS = "seed long, content long, window long, place int"


def _seeds(text_col: str, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for t in texts(field(batch, text_col)):
                w = words(t)
                s = segments(w.hashes, w.start, w.end, length, gram)
                of = np.searchsorted(w.end, s.start, "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(s.anchor)),
                        pa.array(signed(s.content)),
                        pa.array(keys[t.first + of]),
                        pa.array((s.start - w.start[of]).astype(np.int32)),
                        pa.array(s.count.astype(np.int32)),
                    ],
                    ["seed", "content", "key", "at", "windows"],
                )

    return run


def _windows(text_col: str, length: int):
    """Hashes of all windows of the wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            for t in texts(field(batch, text_col)):
                w = words(t)
                wanted = batch.column("wanted").slice(t.first, len(t.start)).to_pylist()
                seed, content, n, hashes = [], [], [], []
                for low, here in zip(w.start.tolist(), wanted):
                    for x in here:
                        at = low + x["at"]
                        seed.append(x["seed"])
                        content.append(x["content"])
                        n.append(x["windows"])
                        hashes.append(of_grams(w.hashes[at : at + x["windows"] + length - 1], length))
                if seed:
                    places = np.concatenate([np.arange(k, dtype=np.int32) for k in n])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array(seed, np.int64), n)),
                            pa.array(np.repeat(np.array(content, np.int64), n)),
                            pa.array(signed(np.concatenate(hashes))),
                            pa.array(places),
                        ],
                        ["seed", "content", "window", "place"],
                    )

    return run


def _remove(text_col: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = batch.column("found").to_pylist()
            out = []
            for t in texts(field(batch, text_col)):
                w = words(t)
                data = t.data.tobytes()
                for i in range(len(t.start)):
                    a, b = w.start[i], w.end[i]
                    cut = merged(found[t.first + i] or [])
                    keeps = np.ones(b - a, bool)
                    for low, high in cut.tolist():
                        keeps[low:high] = False
                    at = np.flatnonzero(keeps) + a
                    kept = b" ".join([data[x:y] for x, y in zip(w.low[at].tolist(), w.high[at].tolist())])
                    out.append(
                        {
                            "n_words": b - a,
                            "n_removed": b - a - len(at),
                            "kept_sha256": hashlib.sha256(kept).hexdigest(),
                            "spans": [{"low": x, "high": y} for x, y in cut.tolist()],
                            "kept": kept.decode() if keep else None,
                        }
                    )
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, OUT_ARROW)], ["row", "out"])

    return run


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 20,
    gram: int = 6,
    keep_text: bool = True,
) -> DataFrame:
    """``row`` and ``out``: each text without the words of passages of ``length`` words or more
    that also start earlier: in a document of smaller id, or further ahead in the same one.

    Words are runs without blanks, kept unchanged and joined by one blank. Null and empty texts
    have no words; a text shorter than ``length`` words loses none. Rows of equal id, or of
    null id (which comes before all others), are not before one another. Writes intermediate
    tables when called.
    """
    rows = keyed(docs, id_col, text_col)
    # Made twice from the texts: once to count them, once to be joined. That costs less than to keep
    # them all, of which most occur once.
    seeds = rows.mapInArrow(_seeds(text_col, length, gram), SEEDS)
    # A table, so that the join has plain shuffles on both sides and hot keys can be split.
    again = stored(
        seeds.groupBy("seed")
        .agg(F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most"))
        .where("n > 1")
        .select("seed", (F.col("least") == F.col("most")).alias("alike")),
        "again",
    )
    ids = rows.select("key", F.col("row")[id_col].alias("id")).distinct()
    shared = stored(seeds.join(again, "seed").join(ids, "key"), "shared")
    kinds = shared.groupBy("seed", "content", "alike").agg(
        F.min(F.struct("id", "at")).alias("first"), F.min(F.struct("id", "at", "key", "windows")).alias("one")
    )
    wanted = (
        kinds.where("not alike")
        .groupBy("one.key")
        .agg(F.collect_list(F.struct("seed", "content", "one.at", "one.windows")).alias("wanted"))
    )
    wanted_rows = rows.select("key", F.struct(F.col("row")[text_col].alias(text_col)).alias("row"))
    windows = wanted_rows.join(wanted, "key").mapInArrow(_windows(text_col, length), WINDOWS)
    placed = stored(
        windows.join(kinds.select("seed", "content", "first"), ["seed", "content"]).select(
            "seed", "content", "window", "place",
            F.struct("first.id", (F.col("first.at") + F.col("place")).alias("at")).alias("mine"),
        ),
        "windows",
    )
    earliest = placed.groupBy("seed", "window").agg(F.min("mine").alias("earliest"))
    # At most as many entries as a seed has windows.
    extended = (
        placed.join(earliest, ["seed", "window"])
        .groupBy("seed", "content")
        .agg(F.collect_set(F.struct("place", "earliest")).alias("sources"))
    )
    here = F.struct("id", (F.col("at") + F.col("s.place")).alias("at"))
    differing = (
        shared.where("not alike")
        .join(extended, ["seed", "content"])
        .select("key", "id", "at", F.explode("sources").alias("s"))
        .where(here > F.col("s.earliest"))
        .select("key", ranges(F.col("at") + F.col("s.place"), F.col("at") + F.col("s.place") + length).alias("span"))
    )
    alike = (
        shared.where("alike")
        .join(kinds.where("alike").select("seed", "first"), "seed")
        .where(F.struct("id", "at") > F.col("first"))
        .select("key", ranges(F.col("at"), F.col("at") + F.col("windows") + (length - 1)).alias("span"))
    )
    found = alike.unionByName(differing).groupBy("key").agg(F.collect_list("span").alias("found"))
    return (
        rows.join(found, "key", "left")
        .select("row", "found")
        .mapInArrow(_remove(text_col, keep_text), table_schema(docs, OUT))
    )
