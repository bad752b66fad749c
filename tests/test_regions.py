"""Points against tables of boxes."""

import math
import random

from pyspark.sql import functions as F

from quern.operators.region_join import box_cells, region_join

BOX = "place bigint, name string, x0 double, x1 double, y0 double, y1 double"


def _random_boxes(rng, n):
    out = []
    for i in range(n):
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        w, h = 2 ** rng.uniform(-6, 6), 2 ** rng.uniform(-6, 6)
        out.append((i, f"r{i}", x, x + w, y, y + h))
    return out


def _brute(points, boxes):
    out = []
    for i, x, y in points:
        if x is None or y is None:
            continue
        hits = [b for b in sorted(boxes, key=lambda b: b[0]) if None not in b and b[2] < x < b[3] and b[4] < y < b[5]]
        if hits:
            out.append((i, hits[0][1]))
    return sorted(out)


def test_first_box_of_all_sizes(spark):
    rng = random.Random(6)
    boxes = _random_boxes(rng, 300)
    boxes += [(1000, "unit", 0.0, 1.0, 0.0, 1.0), (1001, "flat", 3.0, 3.0, 0.0, 9.0), (1002, "turned", 5.0, 4.0, 0.0, 9.0)]
    boxes += [(1003, "null", None, 4.0, 0.0, 9.0), (1004, "tiny", 0.0, 5e-324, 0.0, 5e-324), (1005, "far", 1e300, 2e300, 1e300, 2e300)]
    points = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(1500)]
    edges = [v for b in boxes[:20] for v in b[2:4]]
    points += [(2000 + i, v, boxes[i // 2][4]) for i, v in enumerate(edges)]  # corners are outside
    points += [(3000, 0.0, 0.5), (3001, 1.0, 0.5), (3002, 0.5, 0.5), (3003, None, 1.0), (3004, math.inf, 1.0), (3005, 1.5e300, 1.5e300)]
    points += [(3006, -0.0, 0.0), (3007, math.nan, 0.5)]
    rows = spark.createDataFrame([(*p, "x") for p in points], "id bigint, px double, py double, _x string")
    table = spark.createDataFrame(boxes, BOX)
    got = region_join(rows.withColumnRenamed("_x", "name"), F.col("px"), F.col("py"), table)
    assert got.columns == ["id", "px", "py", "name", "region"]
    assert sorted((r.id, r.region) for r in got.collect()) == _brute(points, boxes)
    none = region_join(rows, F.col("px"), F.col("py"), table.where("false"))
    assert none.count() == 0 and none.columns[-1] == "region"
    assert region_join(rows.where("false"), F.col("px"), F.col("py"), table).count() == 0


def test_ten_thousand_boxes_without_a_nested_loop(spark):
    rng = random.Random(7)
    table = spark.createDataFrame(_random_boxes(rng, 10_000), BOX)
    cells = box_cells(table)
    assert cells.select(F.explode("found")).count() <= 9 * 10_000
    points = spark.range(20_000).select("id", (F.rand(1) * 100 - 50).alias("px"), (F.rand(2) * 100 - 50).alias("py"))
    found = region_join(points, F.col("px"), F.col("py"), table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("HashJoin") + plan.count("SortMergeJoin") >= 1
    some = points.where("id % 40 = 0").collect()
    wanted = _brute([tuple(r) for r in some], [tuple(r) for r in table.collect()])
    assert sorted((r.id, r.region) for r in found.where("id % 40 = 0").collect()) == wanted
