"""Inverted index of lines.

Postings are kept in blocks: all postings of a term whose line ids fall in one range
of ``BLOCK`` ids. A block is the unit of grouping, sorting and gap coding, so the list
of a term that occurs in every line is spread over the whole cluster and no row holds
more than one block. What crosses block borders (the last id before a block) is
computed on one small row per block.

Spark brings every block its border; lists are coded and decoded as whole blocks in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions.tokens import tokens
from quern.plans.scratch import stored
from quern.plans.skew import hot_keys, sliced_join
from quern.sources.lines import LINES_PER_DOCUMENT

# A thousand documents.
BLOCK = 1000 * LINES_PER_DOCUMENT


def postings(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(term, block, line_id, tf)``.

    Occurrences go to their block at once. Counting per line and collecting the block
    afterwards both work inside that partitioning, so this is the only shuffle.
    """
    return (
        lines.select("line_id", F.explode(tokens("line")).alias("term"))
        .withColumn("block", F.floor(F.col("line_id") / block).cast("bigint"))
        .repartition("term", "block")
        .groupBy("term", "block", "line_id")
        .agg(F.count("*").cast("int").alias("tf"))
    )


def _entries(ids: pa.Array, name: str, tf: pa.Array, ends: np.ndarray) -> pa.Array:
    """Lists of (name, tf) that end at ``ends``."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([ids, tf], [name, "tf"]))


def posting_blocks(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(term, block, postings)`` with postings = array of (line_id, tf), ascending."""
    return (
        postings(lines, block)
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("line_id", "tf"))).alias("postings"))
    )


def dictionary(blocks: DataFrame) -> DataFrame:
    """``(term, df)``: number of lines per term."""
    return blocks.groupBy("term").agg(F.sum(F.size("postings")).alias("df"))


def inverted_index(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(term, df, block, postings)``."""
    return with_df(stored(posting_blocks(lines, block), "postings"))


def with_df(blocks: DataFrame) -> DataFrame:
    """Stored posting blocks with the number of lines of their term."""
    terms = stored(dictionary(blocks), "dictionary")
    return sliced_join(blocks, terms, "term", hot_keys(terms, "term", "df"), ["block"]).select(
        "term", "df", "block", "postings"
    )


def flat(blocks: DataFrame) -> DataFrame:
    """One row per posting."""
    kept = [c for c in blocks.columns if c != "postings"]
    return blocks.select(*kept, F.inline("postings"))


def encode_gaps(blocks: DataFrame) -> DataFrame:
    """``(term, block, gaps)`` of stored blocks, with gaps = array of (gap, tf).

    The first gap of a block counts from the last id of the term's previous block, the
    very first from 0.
    """
    last = blocks.select(
        "term", "block", F.element_at("postings", -1).getField("line_id").alias("last_id")
    )
    before = last.select(
        "term",
        "block",
        F.lag("last_id", 1, 0).over(W.partitionBy("term").orderBy("block")).alias("base"),
    )
    return _recoded(blocks.join(before, ["term", "block"]), "postings", "gaps", _gaps)


def _gaps(ids: np.ndarray, starts: np.ndarray, base: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The distance of every id to the one before it, of the first of a list to its base."""
    previous = np.concatenate([[0], ids[:-1]])
    previous[starts] = base
    return ids - previous


def _sums(gaps: np.ndarray, starts: np.ndarray, base: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Running sums of every list, from its base on."""
    sums = np.cumsum(gaps)
    return sums + np.repeat(base - sums[starts] + gaps[starts], sizes)


def _recoded(
    rows: DataFrame, lists: str, into: str, code: Callable[..., np.ndarray]
) -> DataFrame:
    """``(term, block, into)``: the first fields of ``lists``, no list empty, coded anew with the
    ``base`` of their row. What follows from a null is null."""
    first, name = rows.schema[lists].dataType.elementType[0].name, {"gaps": "gap"}.get(into, "line_id")

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entries, sizes = batch[lists].flatten(), batch[lists].value_lengths().to_numpy()
            ends = np.cumsum(sizes, dtype="int64")
            starts = ends - sizes
            was, base = pc.struct_field(entries, first), batch["base"]
            found = code(pc.fill_null(was, 0).to_numpy(), starts, pc.fill_null(base, 0).to_numpy(), sizes)
            missing = was.is_null().to_numpy(zero_copy_only=False)
            no_base = base.is_null().to_numpy(zero_copy_only=False)
            if no_base.any():
                missing = missing.copy()
                if code is _gaps:
                    missing[starts[no_base]] = True
                else:
                    missing |= np.repeat(no_base, sizes)
            coded = pa.array(found, pa.int64(), mask=missing)
            listed = _entries(coded, name, pc.struct_field(entries, "tf"), ends)
            yield pa.record_batch([batch["term"], batch["block"], listed], ["term", "block", into])

    return rows.select("term", "block", "base", lists).mapInArrow(
        recode, f"term string, block bigint, {into} array<struct<{name}:bigint,tf:int>>"
    )


def decode_gaps(encoded: DataFrame) -> DataFrame:
    """Inverse of ``encode_gaps`` on a stored table: running sums within and over blocks."""
    over_blocks = W.partitionBy("term").orderBy("block")
    total = F.aggregate(
        "gaps", F.lit(0).cast("bigint"), lambda total, entry: total + entry.getField("gap")
    )
    base = encoded.select("term", "block", total.alias("total")).select(
        "term", "block", (F.sum("total").over(over_blocks) - F.col("total")).alias("base")
    )
    return _recoded(encoded.join(base, ["term", "block"]), "gaps", "postings", _sums)
