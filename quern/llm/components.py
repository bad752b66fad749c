"""Connected components of links between numbered nodes, as joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that is not the least of its component, the root.

    Rounds of large star and small star: every node hands its greater neighbours, then its
    smaller ones, to the least node it knows. Each round is written to the shared folder; their
    number grows with the logarithm of the nodes. Minima are summed before they are shuffled.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = stored(links.where(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select("u", F.least("u", "least").alias("least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.where("u > v").distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("least"))
        moved = large.join(roots, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        now = stored(moved.unionByName(roots.withColumnRenamed("least", "v")).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
