"""PageRank on whole node records that lie in one layout for good.

Records (adjacency and ranks of a node) are stored in buckets of their node id: the structure
once, ranks once per iteration. Further slices of nodes with very many links would fill one bucket;
they lie apart, evenly, and the ranks of these few nodes are sent to them. An iteration reads both bucket by bucket, without moving either,
sends shares along the links in one shuffle by target, and finds the sums where the next
iteration needs them. Nodes, mass and lost mass of an iteration are observed while it is written, without
a job of their own; the lost mass returns to the sources when the ranks are next read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.operators.pagerank import JUMP
from quern.plans.scratch import fresh_path
from quern.sources.bucketed import open_bucketed, write_bucketed


@dataclass
class Records:
    """``structure`` and ``further`` slices (node_id, out_degree, neighbours) and, after the iterations
    so far, where ``mass`` (node_id, mass) is stored and what of each source's rank was lost."""

    spark: SparkSession
    path: str
    parts: int
    sources: list[int]
    iteration: int = 0
    lost: list[float] = field(default_factory=list)
    counters: list[dict] = field(default_factory=list)

    @property
    def structure(self) -> DataFrame:
        return open_bucketed(self.spark, f"{self.path}/structure")

    @property
    def further(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/further")

    @property
    def mass(self) -> DataFrame:
        return open_bucketed(self.spark, f"{self.path}/mass{self.iteration:04d}")

    def ranks(self, jump: float = JUMP) -> DataFrame:
        """``(node_id, out_degree, neighbours, ranks)``: records and further slices of nodes that have
        rank, ``main`` telling them apart; one rank per source."""
        mass, further = self.mass, self.further
        # No more nodes than have several slices, and those are few by the definition of a slice.
        of_hot = mass.join(F.broadcast(self.spark.read.parquet(f"{self.path}/hot")), "node_id")
        known = self.structure.join(mass, "node_id", "left").withColumn("main", F.lit(True))
        more = further.join(F.broadcast(of_hot), "node_id", "left").withColumn("main", F.lit(False))
        start = self.iteration == 0
        ranks = [
            F.coalesce(F.col("mass")[i], F.lit(0.0)) * F.lit(1.0 if start else 1.0 - jump)
            + F.when(F.col("node_id") == s, F.lit(0.0 if start else jump + (1.0 - jump) * self.lost[i])).otherwise(0.0)
            for i, s in enumerate(self.sources)
        ]
        rows = known.unionByName(more).select("node_id", "main", "out_degree", "neighbours", F.array(*ranks).alias("ranks"))
        return rows.where(F.exists("ranks", lambda r: r > 0))


def store_records(records: DataFrame, sources: Sequence[int], path: str | None = None, parts: int | None = None) -> Records:
    """Lay out the records of ``graph_nodes`` for ``sources`` in ``parts`` buckets of the node id.

    The number is that of shuffle partitions by default: then the sums of an iteration lie like the
    records.
    """
    spark = records.sparkSession
    path = path or fresh_path(spark, "records")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    structure = records.where("slice = 0").select("node_id", "out_degree", "neighbours")
    write_bucketed(structure, f"{path}/structure", parts, "node_id", "node_id")
    more = records.where("slice > 0").select("node_id", "out_degree", "neighbours")
    more.repartition(parts).write.mode("overwrite").parquet(f"{path}/further")
    more.select("node_id").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/hot")
    start = records.where((F.col("slice") == 0) & F.exists("ranks", lambda r: r > 0))
    write_bucketed(start.select("node_id", F.col("ranks").alias("mass")), f"{path}/mass0000", parts, "node_id", "node_id")
    return Records(spark, path, parts, list(sources))


def records_step(records: Records, jump: float = JUMP) -> DataFrame:
    """``(node_id, mass)``: for every known node the rank of each source that arrives along links."""
    sent = records.ranks(jump).select(
        F.explode("neighbours").alias("node_id"),
        F.transform("ranks", lambda r: r / F.col("out_degree")).alias("shares"),
    )
    sums = [F.sum(F.col("shares")[i]) for i in range(len(records.sources))]
    arrived = sent.groupBy("node_id").agg(F.array(*sums).alias("mass"))
    return arrived.join(records.structure.select("node_id"), "node_id", "left_semi")


def iterate(records: Records, iterations: int, jump: float = JUMP) -> Records:
    """Run iterations; ``counters`` gets a dict for each: nodes reached, mass and lost mass by source."""
    for _ in range(iterations):
        seen = Observation()
        of = {f"mass_{s}": F.coalesce(F.sum(F.col("mass")[i]), F.lit(0.0)).alias(f"mass_{s}") for i, s in enumerate(records.sources)}
        after = records_step(records, jump).observe(seen, F.count(F.lit(1)).alias("nodes"), *of.values())
        target = f"{records.path}/mass{records.iteration + 1:04d}"
        write_bucketed(after, target, records.parts, "node_id", "node_id", dealt=True)
        found = seen.get
        lost = [max(0.0, 1.0 - found[name]) for name in of]
        records = Records(
            records.spark, records.path, records.parts, records.sources, records.iteration + 1, lost,
            [*records.counters, found | {f"lost_{s}": x for s, x in zip(records.sources, lost, strict=True)}],
        )
    return records


def flat_ranks(records: Records, jump: float = JUMP) -> DataFrame:
    """``(source, node_id, rank)`` of positive ranks."""
    rows = records.ranks(jump).where("main").select("node_id", F.posexplode("ranks").alias("i", "rank"))
    names = F.array(*[F.lit(s).cast("bigint") for s in records.sources])
    return rows.where("rank > 0").select(names[F.col("i")].alias("source"), "node_id", "rank")
