"""Multi-source personalized PageRank.

Ranks are rows ``(source, node_id, rank)`` with positive rank only, so their number
follows the part of the graph each source has reached. A node passes its rank along
its weighted links; what is lost on the way (no out-edges, or a target without node
record) goes back to the source. Lost shares are links without target, so one join
and one sum per iteration move all the mass.

The links are laid out and sorted once by (src, slice) and kept so for every iteration;
only rank rows move. Nodes with very many links are cut into slices, and their rank rows
are repeated per slice. Each iteration is written to the shared folder: that is the state a later run
resumes from, and it keeps the plan of an iteration free of all earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.operators.graph import graph_duplicate_nodes, weighted_links
from quern.plans.scratch import checkpointed, fresh_path, stored
from quern.plans.skew import ROWS_PER_SLICE, hot_keys, per_slice, with_slice
from quern.sources.files import exists, shuffle_parts

# Fixed value: the chance of a jump back to the source.
JUMP = 0.15


@dataclass
class Links:
    """Weighted links, laid out by (src, slice), and the nodes that have several slices."""

    rows: DataFrame
    hot: DataFrame

    def release(self) -> None:
        self.rows.unpersist()

    def of(self, ranks: DataFrame) -> DataFrame:
        """Every rank row with every link of its node."""
        placed = per_slice(ranks.withColumnRenamed("node_id", "src"), "src", self.hot)
        return placed.join(self.rows, ["src", "slice"])


def checked_links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The weighted links, not computed yet, after a check of the node records."""
    twice = graph_duplicate_nodes(nodes).limit(1).count()
    if twice:
        raise ValueError("a node id has more than one record")
    return weighted_links(nodes, edges)


def prepare_links(
    nodes: DataFrame, edges: DataFrame, links_per_slice: int = ROWS_PER_SLICE
) -> Links:
    """Check the node records and lay out the links."""
    return laid_out(stored(checked_links(nodes, edges), "links"), links_per_slice)


def laid_out(weighted: DataFrame, links_per_slice: int = ROWS_PER_SLICE) -> Links:
    """Weighted links of a table, laid out for all iterations."""
    counts = weighted.groupBy("src").agg(F.count("*").alias("links"))
    hot = checkpointed(hot_keys(counts, "src", "links", links_per_slice))
    rows = with_slice(weighted, "src", hot, ["dst", "weight"])
    # With a fixed number of partitions the cached links satisfy the join of every
    # iteration as they are; the planner knows their layout once they have been counted.
    # Cached blocks of a lost executor are rebuilt from the stored table of links.
    parts = shuffle_parts(weighted)
    placed = rows.repartition(parts, "src", "slice").sortWithinPartitions("src", "slice")
    placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
    placed.count()
    return Links(placed, hot)


def initial_ranks(nodes: DataFrame, sources: Sequence[int]) -> DataFrame:
    """Rank 1 on each source."""
    return nodes.where(F.col("node_id").isin(list(sources))).select(
        F.col("node_id").alias("source"), "node_id", F.lit(1.0).alias("rank")
    )


def ppr_step(links: Links, ranks: DataFrame) -> DataFrame:
    """``(source, node_id, mass)``: the rank that arrives at known nodes along links."""
    return (
        links.of(ranks)
        .where(F.col("dst").isNotNull())
        .groupBy("source", F.col("dst").alias("node_id"))
        .agg(F.sum(F.col("rank") * F.col("weight")).alias("mass"))
    )


def ppr_missing_mass(links: Links, ranks: DataFrame) -> DataFrame:
    """``(source, missing)``: the rank that does not arrive, 0 when nothing is lost."""
    lost = F.when(F.col("dst").isNull(), F.col("rank") * F.col("weight")).otherwise(0.0)
    return links.of(ranks).groupBy("source").agg(F.sum(lost).alias("missing"))


def ppr_iteration(links: Links, ranks: DataFrame, jump: float = JUMP) -> DataFrame:
    """The ranks after one iteration.

    Mass along links and lost mass are the same sum, the latter addressed to the source.
    """
    moved = links.of(ranks).select(
        "source",
        F.coalesce("dst", "source").alias("node_id"),
        (F.lit(1.0 - jump) * F.col("rank") * F.col("weight")).alias("rank"),
    )
    jumped = ranks.select("source").distinct().select(
        "source", F.col("source").alias("node_id"), F.lit(jump).alias("rank")
    )
    return (
        moved.unionByName(jumped)
        .groupBy("source", "node_id")
        .agg(F.sum("rank").alias("rank"))
        .where("rank > 0")
    )


def iteration_path(state: str, iteration: int) -> str:
    return f"{state}/iteration={iteration:04d}"


def personalized_pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    sources: Sequence[int],
    iterations: int,
    jump: float = JUMP,
    state: str | None = None,
    start: int = 0,
    counters: list[dict] | None = None,
) -> DataFrame:
    """``(source, node_id, rank)`` after ``iterations`` iterations.

    ``counters`` gets the rank rows and the total rank of every iteration run, observed while it
    is written.

    ``state`` is a folder shared by the cluster with one table per iteration. With
    ``start`` > 0 the run goes on from that iteration's table, with the weighted links that the run
    from 0 has left beside it; ``nodes`` and ``edges`` have to be those of that run. Links are only
    made again where there are none.
    """
    spark = nodes.sparkSession
    state = state or fresh_path(spark, "ranks")
    if start == 0:
        initial_ranks(nodes, sources).write.mode("overwrite").parquet(iteration_path(state, 0))
    links = laid_out(_links_of(state, nodes, edges, start))
    for done in range(start, iterations):
        ranks = read_ranks(spark, state, done)
        after = ppr_iteration(links, ranks, jump)
        seen = Observation()
        after = after.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum("rank").alias("rank"))
        after.write.mode("overwrite").parquet(iteration_path(state, done + 1))
        if counters is not None:
            counters.append({"iteration": done + 1, **seen.get})
    links.release()
    return read_ranks(spark, state, iterations)


def _links_of(state: str, nodes: DataFrame, edges: DataFrame, start: int) -> DataFrame:
    """The weighted links that lie in ``state``; they are written there unless a run resumes on them."""
    spark, path = nodes.sparkSession, f"{state}/links"
    # The mark of Spark's writers: links that a run has not written to their end are made again.
    if start == 0 or not exists(spark, f"{path}/_SUCCESS"):
        checked_links(nodes, edges).write.mode("overwrite").parquet(path)
    return spark.read.schema("src bigint, dst bigint, weight double").parquet(path)


def read_ranks(spark: SparkSession, state: str, iteration: int) -> DataFrame:
    return spark.read.schema("source bigint, node_id bigint, rank double").parquet(
        iteration_path(state, iteration)
    )


def ppr_topk(ranks: DataFrame, k: int) -> DataFrame:
    """``(source, place, node_id, rank)``: the k best nodes per source, equal ranks by node id.

    The limit is applied in every task before rows are shuffled.
    """
    best = W.partitionBy("source").orderBy(F.desc("rank"), "node_id")
    return (
        ranks.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .select("source", "place", "node_id", "rank")
    )
