"""Rows, keys and intermediate tables shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.plans.scratch import stored

_KINDS = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "binary": T.BinaryType(), "boolean": T.BooleanType(),
    "ranges": T.ArrayType(T.StructType().add("low", T.LongType()).add("high", T.LongType())),
    "strings": T.ArrayType(T.StringType()),
}


def columns(**kinds: str) -> T.StructType:
    """A schema from column names and kinds; needs no session, as workers import it too."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in kinds.items()])


__all__ = ["keyed", "ranges", "merged", "stored", "field", "table_schema", "columns", "portions"]


def portions(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that what is made of a slice stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` and ``key``, 64 bits of id and text: repeated rows share it, other rows don't."""
    return docs.select(F.struct("*").alias("row")).select(
        "row", F.xxhash64(F.col("row")[id_col], F.col("row")[text_col]).alias("key")
    )


def field(batch: pa.RecordBatch, name: str, column: str = "row") -> pa.Array:
    """One field of a struct column."""
    return batch.column(batch.schema.get_field_index(column)).field(name)


def table_schema(docs: DataFrame, out: T.StructType) -> T.StructType:
    """Schema of ``row`` and ``out``."""
    return T.StructType([T.StructField("row", docs.schema), T.StructField("out", out)])


def ranges(low: Column, high: Column) -> Column:
    """A list of one range from ``low`` to before ``high``."""
    return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))


def merged(found: list[dict]) -> np.ndarray:
    """Maximal runs covered by ranges, as an array of (low, high); touching ranges are one run."""
    if not found:
        return np.zeros((0, 2), np.int64)
    pairs = np.array([(r["low"], r["high"]) for r in found], np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    opens = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > reach[:-1])))
    closes = np.concatenate((opens[1:], [len(pairs)])) - 1
    return np.stack((pairs[opens, 0], reach[closes]), axis=1)
