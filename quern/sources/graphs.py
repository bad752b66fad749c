"""Graphs as adjacency text: ``node neighbour neighbour ...`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(node_id, neighbours)``; a line with one number is a node without out-edges."""
    numbers = F.split(F.trim(F.regexp_replace(column, r"\s+", " ")), " ").cast("array<bigint>")
    return lines.where(F.trim(column) != "").select(
        F.element_at(numbers, 1).alias("node_id"),
        F.slice(numbers, F.lit(2), F.size(numbers) - 1).alias("neighbours"),
    )


def adjacency_nodes(adjacency: DataFrame) -> DataFrame:
    return adjacency.select("node_id")


def adjacency_edges(adjacency: DataFrame) -> DataFrame:
    """``(src, dst)``, repeated edges kept."""
    return adjacency.select(
        F.col("node_id").alias("src"), F.explode("neighbours").alias("dst")
    )
