"""Points to the boxes of a table, by a join on grid cells.

A box belongs to the level whose cells, with sides of a power of two, are as wide as its longer
side or wider by less than two times; so it touches nine cells at most, however large or small it
is. The boxes of a cell make one row, in their order. A point looks up its cell at every level in use,
an equi-join per level whose result is exact after a test of the few boxes found there; points are
neither repeated nor grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.plans.scratch import stored

# Beyond it a side of a cell is less than the distance of neighbouring doubles.
FARTHEST = float(1 << 53)


def _cell(at: Column, level: Column) -> Column:
    """Number of the cell; null where no box of the level can be. Dividing by a power of two is
    exact, so the cells keep the order of points and sides."""
    number = at / F.pow(F.lit(2.0), level)
    return F.when(F.abs(number) < FARTHEST, F.floor(number))


def box_cells(boxes: DataFrame) -> DataFrame:
    """``(level, cx, cy, found)``: the boxes that touch a cell, (place, name, x0, x1, y0, y1), by place.

    ``boxes`` has ``place, name, x0, x1, y0, y1``. Boxes without an inside, with a null side or
    side without end hold no point.
    """
    sides = ("x0", "x1", "y0", "y1")
    finite = F.lit(True)
    for side in sides:
        finite = finite & (F.abs(F.col(side)) < float("inf"))
    longer = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.ceil(F.log2(longer)).cast("int")
    placed = boxes.where(finite & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))).withColumn("level", level)
    across = lambda low, high: F.sequence(_cell(F.col(low), F.col("level")), _cell(F.col(high), F.col("level")))
    return (
        placed.withColumn("cx", F.explode(across("x0", "x1")))
        .withColumn("cy", F.explode(across("y0", "y1")))
        .groupBy("level", "cx", "cy")
        .agg(F.sort_array(F.collect_list(F.struct("place", "name", *sides))).alias("found"))
    )


def region_join(points: DataFrame, x: Column, y: Column, boxes: DataFrame, name: str = "region") -> DataFrame:
    """Rows whose point lies inside a box of the table, with the name of the first such box.

    ``boxes`` has ``place`` (its order, smallest first), ``name`` and the open sides ``x0, x1, y0, y1``.
    Points with a null or infinite coordinate are in no box. Writes the cells of the boxes when called.
    """
    cells = stored(box_cells(boxes), "cells")
    # One row per level: at most one per power of two between the smallest and the largest box.
    levels = sorted(r.level for r in cells.select("level").distinct().collect())
    rows = points.withColumns({"_x": x.cast("double"), "_y": y.cast("double")})
    first = []
    for i, level in enumerate(levels):
        at = cells.where(F.col("level") == level).select(
            F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("found").alias(f"_found_{i}")
        )
        here = (F.col("_cx") == _cell(F.col("_x"), F.lit(level))) & (F.col("_cy") == _cell(F.col("_y"), F.lit(level)))
        rows = rows.join(at, here, "left").drop("_cx", "_cy")
        inside = F.filter(
            f"_found_{i}",
            lambda b: (F.col("_x") > b["x0"]) & (F.col("_x") < b["x1"]) & (F.col("_y") > b["y0"]) & (F.col("_y") < b["y1"]),
        )
        first.append(F.get(inside, F.lit(0)))
    if not first:
        return points.withColumn(name, F.lit(None).cast(boxes.schema["name"].dataType)).where(F.lit(False))
    of_all = F.least(*first) if len(first) > 1 else first[0]
    return rows.withColumn(name, of_all["name"]).where(F.col(name).isNotNull()).select(*points.columns, name)
