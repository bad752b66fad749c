"""Joins in which one key may hold a large share of all rows.

``hot_keys`` reads a table of counts per key and returns the keys that need more
than one task, with the number of slices each is cut into. Every key it returns
holds more than ``total / max_keys`` rows, so it returns fewer than ``max_keys``
rows whatever the data: that is the bound under which the result is broadcast.

``sliced_join`` spreads the rows of a hot key over its slices on the large side
and repeats the matching rows once per slice on the other side. Every other key
has one slice. The result is exactly that of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 2_000_000
MAX_HOT_KEYS = 50_000


def hot_keys(
    counts: DataFrame,
    key: str,
    weight: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``(key, slices)`` for the keys of ``counts`` with too many rows for one task."""
    total = counts.agg(F.sum(weight)).scalar()
    limit = F.greatest(F.lit(float(rows_per_slice)), total / F.lit(max_keys))
    return counts.where(F.col(weight) > limit).select(
        key, F.ceil(F.col(weight) / F.lit(rows_per_slice)).cast("int").alias("slices")
    )


def with_slice(rows: DataFrame, key: str, hot: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Add ``slice``: a hash of ``spread_by`` within a hot key, 0 for any other key."""
    return rows.join(F.broadcast(hot), key, "left").withColumn(
        "slice",
        F.when(
            F.col("slices").isNotNull(),
            F.pmod(F.xxhash64(*spread_by), F.col("slices")).cast("int"),
        ).otherwise(F.lit(0)),
    ).drop("slices")


def per_slice(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat each row once for every slice of its key."""
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
        .drop("slices")
    )


def sliced_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Sequence[str],
    how: str = "inner",
    parts: int | None = None,
) -> DataFrame:
    """``facts`` joined to ``lookup`` on ``key``; ``how`` is inner, left, left_semi or left_anti.

    ``parts`` fixes the number of partitions, so that they are not merged by compressed size."""
    large, small = with_slice(facts, key, hot, spread_by), per_slice(lookup, key, hot)
    if parts is not None:
        large, small = large.repartition(parts, key, "slice"), small.repartition(parts, key, "slice")
    return large.join(small, [key, "slice"], how).drop("slice")
