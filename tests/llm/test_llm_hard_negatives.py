"""Hard negatives against brute force; intervals against exact products."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm.hard_negatives import Block, _coded, hard_negatives, rotated


def _block(x):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(x))), pa.array(np.zeros(len(x), int)), pa.array(np.zeros(len(x), bool)),
         pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(x.tolist(), pa.list_(pa.float64()))],
        ["id", "label", "anchor", "dim", "vector"],
    )
    return Block(pa.Table.from_batches(list(_coded(256.0)(iter([batch])))))


@pytest.mark.parametrize("dim", [1, 3, 64, 100, 200])
def test_intervals_hold(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(300, dim)) * rng.choice([1e-3, 1, 50], (300, 1))
    x[:40] = x[40:80] * rng.uniform(0.9, 1.1, (40, dim))
    x[5] = 0
    block = _block(x)
    assert np.array_equal(block.q, np.floor(256 * x))
    turned = rotated(block.q)
    assert np.allclose(turned @ turned.T, block.q @ block.q.T, atol=1e-3)
    middle, least, most = block.intervals(block.q[:60])
    exact = block.q[:60] @ block.q.T
    assert (least <= exact).all() and (exact <= most).all() and ((least <= middle) & (middle <= most)).all()
    if dim >= 64:
        assert np.mean(most - least) < 1.5 * np.mean(block.norm[:60, None] * block.norm)


def _brute(rows, k=5, m=3):
    rows = [
        (i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    rows = [(i, lab, q) for n, (i, lab, q) in enumerate(rows) if (i, lab, q) not in rows[:n]]
    out = []
    for a, label, q in rows:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r, strict=True)), i, lab) for i, lab, r in rows if i != a and len(r) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            fine = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fine[:m])]
    return sorted(out)


def _mined(df, **options):
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 50 == 0, **options).collect()))


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    centres = rng.normal(size=(6, 64))
    for i in range(600):
        v = centres[i % 6] + rng.normal(size=64) * rng.choice([0.05, 0.4, 1.0])
        rows.append((i, int(rng.integers(0, 4)), (v / np.linalg.norm(v)).tolist()))
    rows += [(1000 + i, i % 3, rows[50][2]) for i in range(80)]  # one vector very often, ids of anchors among them
    rows += [(2000, None, rows[0][2]), (2050, 1, None), (2100, 1, [None] * 64), (None, 1, rows[0][2]), (2150, 1, [0.0] * 64)]
    rows += [(2200, 2, [float("nan")] * 64), (2201, 2, [float("inf")] + [0.0] * 63), (2250, 2, (-centres[0]).tolist())]
    rows += [rows[3], rows[50], (4000, 3, [0.5, 0.1]), (4001, 3, [0.4, 0.2]), (4002, 1, [0.2, 0.2]), (4050, 1, []), (4051, 1, []), (4052, 2, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, score string")
    wanted = _brute(rows)
    assert len(wanted) > 60 and any(r[1] >= 4000 for r in wanted)
    assert _mined(df) == wanted
    assert _mined(df.repartition(3), rows_per_block=90, anchors_per_block=3) == wanted
    assert _mined(df, positives=2, negatives=5) == _brute(rows, 2, 5)
    assert _mined(df.where("false")) == [] and _mined(df.where("vec_id % 50 != 0")) == []


def test_large_components_are_held(spark):
    rows = [(0, 1, [3e300, 1.0]), (1, 1, [3e300, 0.0]), (2, 2, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    most = math.isqrt(2**52)
    assert _mined(df) == [] and most * most <= 2**53
