"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document has an exponential key, -ln(u) / weight, with u from a hash of its id. A source
with a target above its size is taken in complete epochs first; of the rest, documents are
taken by ascending key until their sizes reach the budget.

A source may hold most documents, so its keys are cut into bins of about equal share of all
rows, numbered by 1 - exp(-key), which ascends with the key and is spread evenly for weights
near one. Sizes are summed within bins and over the bins before; the result does not depend on
the number of bins. Only a table of one row per source is ranked as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
BINS_PER_PARTITION = 4


def word_count(text: str) -> Column:
    """Blank-separated words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: Column, seed: str) -> Column:
    """A number between 0 and 1 that depends on id and seed alone; 52 bits of an MD5 sum."""
    digest = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("/" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``sizes`` (source, source_size, n) with ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes.
    No target exceeds ``cap`` times its source's size; what is over is shared by weight among
    the others: each gets ``level`` times its weight, the level at which all is given out.
    """
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")
    )
    most = F.col("source_size") * F.lit(float(cap))
    whole = Window.partitionBy(F.lit(0))
    rising = whole.orderBy("full_at", "rank")
    ranked = (
        ranked.withColumn("weight", weight)
        .withColumn("most", most)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("rows", F.sum("n").over(whole))
        .withColumn(
            "full", F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        )
        .withColumn("open", F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))).over(whole)["level"])
    )
    target = F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("most")), F.col("most"))
    return ranked.select("source", "rank", "source_size", "n", "rows", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    quality_col: str | None = None,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3.0,
    seed: str = "mix",
) -> DataFrame:
    """``row`` and ``out`` (source_size, target, epochs, partial, taken): how much of each
    document the mix takes. Carry no texts along in ``docs``; sizes are enough.

    A null size is 0, a null or not positive quality the smallest weight (1e-3). Null is a
    source of its own. Rows of equal id have equal keys and are taken in the order of their
    sizes. The document at the edge of a budget is taken if that brings the sum nearer to it.
    An empty table gives no rows. Writes one intermediate table when called.
    """
    row = F.col("row")
    size = F.coalesce(row[size_col], F.lit(0)).cast("long")
    quality = F.lit(1.0) if quality_col is None else row[quality_col].cast("double")
    heavy = F.greatest(F.coalesce(quality, F.lit(0.0)), F.lit(1e-3))
    keys = stored(
        docs.select(F.struct("*").alias("row")).select(
            "row",
            row[source_col].alias("source"),
            size.alias("size"),
            row[id_col].alias("id"),
            (-F.log(uniform(row[id_col], seed)) / heavy).alias("key"),
        ),
        "keys",
    )
    sizes = keys.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.col("n") * F.lit(BINS_PER_PARTITION * partitions) / F.col("rows")
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    plan = (
        targets(sizes, weights, cap)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("bins", F.ceil(share))
        .drop("n", "rows")
    )
    placed = keys.join(plan, keys["source"].eqNullSafe(plan["source"])).drop("source")
    placed = placed.withColumn(
        "bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("bins")), F.col("bins") - 1)
    )
    before = Window.partitionBy("rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("rank", "bin")
        .agg(F.sum("size").alias("bin_size"))
        .select("rank", "bin", F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("start"))
    )
    inside = (
        Window.partitionBy("rank", "bin")
        .orderBy("key", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ahead = F.col("start") + F.col("before")
    partial = (ahead < F.col("rest")) & (
        ahead + F.col("size") - F.col("rest") <= F.col("rest") - ahead
    )
    return summed.join(starts, ["rank", "bin"]).select(
        "row",
        F.struct(
            F.col("size"),
            F.col("source_size"),
            F.col("target"),
            F.col("epochs"),
            partial.alias("partial"),
            (F.col("epochs") * F.col("size") + F.when(partial, F.col("size")).otherwise(F.lit(0))).alias("taken"),
        ).alias("out"),
    )
