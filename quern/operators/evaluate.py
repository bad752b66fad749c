"""Area under the ROC curve by a distributed running sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.plans.scratch import stored

POINTS_PER_PART = 1_000_000


def ham_below(
    points: DataFrame, group: str = "model_id", points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """``points`` with ``part`` and ``ham_below``: the sum of ``ham`` over lower scores of the group.

    ``points`` has one row per group and score. The rows are dealt by range of (group, score) into
    parts of about ``points_per_part``, as many as that takes. The total of each part runs over the
    parts of a group, the ham within a part over its rows: no task sees more than a part, and the
    list that is summed as a whole has a row per part and group in it. Writes the dealt points.
    """
    parts = -(-points.count() // points_per_part) or 1
    dealt = stored(
        points.repartitionByRange(parts, group, "score").withColumn("part", F.spark_partition_id()),
        "dealt",
    )
    totals = dealt.groupBy(group, "part").agg(F.sum("ham").alias("total"))
    before = totals.select(
        F.col(group).alias("_group"),
        F.col("part").alias("_part"),
        (F.sum("total").over(W.partitionBy(group).orderBy("part")) - F.col("total")).alias("before"),
    )
    inside = F.sum("ham").over(W.partitionBy(group, "part").orderBy("score")) - F.col("ham")
    same = (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return (
        dealt.withColumn("inside", inside)
        .join(before, same)
        .withColumn("ham_below", F.col("inside") + F.col("before"))
        .drop("inside", "before", "_group", "_part")
    )


def one_minus_roca(
    scored: DataFrame, group: str = "model_id", points_per_part: int = POINTS_PER_PART
) -> DataFrame:
    """``(group, one_minus_roca)``: 1 - area under the ROC curve, in percent, ties half.

    The area is the share of (spam, ham) pairs in which the spam scores higher. Equal scores of a
    group become one point first, so ties are exact; null scores tie below all others. A group
    without spam or without ham has no area: null.
    """
    points = stored(
        scored.groupBy(group, "score").agg(
            F.count_if(F.col("label") == 1).alias("spam"),
            F.count_if(F.col("label") != 1).alias("ham"),
        ),
        "points",
    )
    won = F.col("spam").cast("double") * (F.col("ham_below") + F.col("ham") / 2)
    return (
        ham_below(points, group, points_per_part)
        .groupBy(group)
        .agg(F.sum(won).alias("won"), F.sum("spam").alias("spam"), F.sum("ham").alias("ham"))
        .select(
            group,
            ((1 - F.try_divide(F.try_divide("won", "spam"), F.col("ham"))) * 100).alias("one_minus_roca"),
        )
    )
