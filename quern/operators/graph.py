"""Graph records and checks. Nodes are ``(node_id)``, edges are ``(src, dst)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.scratch import stored
from quern.plans.skew import ROWS_PER_SLICE, hot_keys, per_slice, sliced_join, with_slice
from quern.sources.files import shuffle_parts


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count("*").alias("out_degree"))


def graph_nodes(
    nodes: DataFrame,
    edges: DataFrame,
    sources: Sequence[int],
    neighbours_per_row: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(node_id, slice, out_degree, neighbours, ranks)``, one row per node.

    ``ranks`` is the start rank for each source: 1 on the source itself, else 0. A node
    with more than ``neighbours_per_row`` out-edges is stored in several slices, from 0 on.
    """
    degrees = stored(out_degrees(edges).withColumnRenamed("src", "node_id"), "degrees")
    hot = hot_keys(degrees, "node_id", "out_degree", neighbours_per_row)
    links = with_slice(edges.withColumnRenamed("src", "node_id"), "node_id", hot, ["dst"])
    adjacency = links.groupBy("node_id", "slice").agg(
        F.sort_array(F.collect_list("dst")).alias("neighbours")
    )
    ranks = F.array(
        *[F.when(F.col("node_id") == s, 1.0).otherwise(0.0) for s in sources]
    )
    return (
        per_slice(nodes.join(degrees, "node_id", "left"), "node_id", hot)
        .join(adjacency, ["node_id", "slice"], "left")
        .select(
            "node_id",
            "slice",
            F.coalesce("out_degree", F.lit(0).cast("bigint")).alias("out_degree"),
            F.coalesce("neighbours", F.array().cast("array<bigint>")).alias("neighbours"),
            ranks.alias("ranks"),
        )
    )


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, and nodes with at least one out-edge."""
    counted = nodes.select(F.lit(1).alias("node"), F.lit(0).alias("edges")).unionAll(
        out_degrees(edges).select(F.lit(0), F.col("out_degree"))
    )
    return counted.agg(
        F.sum("node").alias("num_nodes"),
        F.sum("edges").alias("num_edges"),
        F.count_if(F.col("edges") > 0).alias("num_active_nodes"),
    )


def graph_partition(records: DataFrame, parts: int, by: str = "id") -> DataFrame:
    """Node records as they are, with whatever columns they have, laid out in ``parts`` partitions:
    by node id modulo ``parts``, or, with ``by="range"``, in ranges of node ids."""
    if by == "range":
        return records.repartitionByRange(parts, "node_id")
    return records.repartitionById(parts, F.pmod("node_id", F.lit(parts)).cast("int"))


def partition_report(partitioned: DataFrame) -> DataFrame:
    """``(part, num_nodes, num_edges)`` of records of ``graph_nodes``, as the rows actually lie."""
    return (
        partitioned.select(F.spark_partition_id().alias("part"), "slice", F.size("neighbours").alias("edges"))
        .groupBy("part")
        .agg(F.count_if(F.col("slice") == 0).alias("num_nodes"), F.sum("edges").alias("num_edges"))
    )


def graph_missing_structure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(dst, num_edges)``: targets of edges that have no node record."""
    targets = edges.groupBy("dst").agg(F.count("*").alias("num_edges"))
    return targets.join(nodes, F.col("dst") == F.col("node_id"), "left_anti")


def graph_duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """``(node_id, records)`` for nodes with more than one record."""
    return nodes.groupBy("node_id").agg(F.count("*").alias("records")).where("records > 1")


def weighted_links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(src, dst, weight)``: the share of its rank a node passes on, per target.

    Repeated edges are summed into one weight. Shares that reach no node record, and
    the whole rank of a node without out-edges, are lost; they have no ``dst``, so the
    weights of every node add up to 1.
    """
    parts = shuffle_parts(edges)
    degrees = stored(out_degrees(edges), "degrees")
    hot = hot_keys(degrees, "src", "out_degree")
    # Edges go to the slice of their source once: repeated ones are counted and joined there.
    repeated = (
        with_slice(edges.select("src", "dst"), "src", hot, ["dst"])
        .repartition(parts, "src", "slice")
        .groupBy("src", "slice", "dst")
        .agg(F.count("*").alias("times"))
    )
    sliced = per_slice(degrees, "src", hot).repartition(parts, "src", "slice")
    shares = repeated.join(sliced, ["src", "slice"]).select(
        "src", "dst", (F.col("times") / F.col("out_degree")).alias("weight")
    )

    in_degrees = stored(edges.groupBy("dst").agg(F.count("*").alias("in_degree")), "degrees")
    known = nodes.select(F.col("node_id").alias("dst"), F.lit(True).alias("known"))
    reached = sliced_join(
        shares, known, "dst", hot_keys(in_degrees, "dst", "in_degree"), ["src"], "left", parts
    ).select("src", F.when(F.col("known"), F.col("dst")).alias("dst"), "weight")

    dangling = nodes.join(degrees, F.col("node_id") == F.col("src"), "left_anti").select(
        F.col("node_id").alias("src"),
        F.lit(None).cast("bigint").alias("dst"),
        F.lit(1.0).alias("weight"),
    )
    return reached.unionByName(dangling)
