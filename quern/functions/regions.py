"""Points to named boxes: a few boxes as literals, any number of them as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """An open box: a point on its border is outside."""

    name: str
    x0: float
    x1: float
    y0: float
    y1: float

    def holds(self, x: Column, y: Column) -> Column:
        return (x > self.x0) & (x < self.x1) & (y > self.y0) & (y < self.y1)


# The two company sites of the taxi stream, longitude then latitude.
TAXI_SITES = (
    Box("goldman", -74.0144185, -74.013777, 40.7138745, 40.7152275),
    Box("citigroup", -74.012083, -74.009867, 40.720053, 40.7217236),
)
# Positions of drop-off longitude and latitude per kind of taxi record.
TAXI_GREEN = "green"
TAXI_GREEN_AT = (8, 9)
TAXI_OTHER_AT = (10, 11)


def region_of(x: Column, y: Column, boxes: Sequence[Box]) -> Column:
    """Name of the first listed box that holds the point, null for none.

    The boxes are literals of the caller, so this is a test per row and needs no join.
    """
    return F.coalesce(*[F.when(box.holds(x, y), F.lit(box.name)) for box in boxes])


def region_assign(
    points: DataFrame, x: Column, y: Column, boxes: Sequence[Box], name: str = "region"
) -> DataFrame:
    """Rows whose point lies in a box, with its name."""
    return points.withColumn(name, region_of(x, y, boxes)).where(F.col(name).isNotNull())


def taxi_point(fields: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a taxi record split at its commas."""
    green = fields.getItem(0) == TAXI_GREEN
    x, y = (
        F.when(green, fields.getItem(g)).otherwise(fields.getItem(o)).cast("double")
        for g, o in zip(TAXI_GREEN_AT, TAXI_OTHER_AT)
    )
    return x, y
