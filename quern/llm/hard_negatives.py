"""Hard negatives from rotated one-bit codes with exact integer scores.

Components become integers, ``floor(scale * x)``. A vector is rotated (rounds of fixed random
signs and a Walsh-Hadamard transform) and coded by the signs of its components; with the code
go its length and its alignment, the cosine between rotated vector and code vector. An
anchor's rotated components are rounded to six bits, so that its product with a code vector is
a sum of popcounts over bit planes.

With alignment ``a``, the score is ``|v| (a s + sqrt(1 - a^2) <e, q>)``, where ``s`` is the
product of anchor and code vector and ``e`` a unit vector across the code vector: by
Cauchy-Schwarz the last term is at most the anchor's part across it, and the rounding of the
anchor adds at most ``|v|`` times the rounding error. That interval holds always. Rows whose interval
reaches neither the best exact scores so far nor the asked window are left out; all others
are scored in integers.

Anchors meet rows in blocks: for positives those of their label, for negatives all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.tables import stored

PLANES = 6
TOP = (1 << (PLANES - 1)) - 1
SLICE = 32  # anchors whose intervals with a block of rows are held at once
MOST = 1 << 53  # scores stay below it


def _width(dim: int) -> int:
    """Components after filling up: a power of two, at least one machine word of bits."""
    return max(64, 1 << max(0, dim - 1).bit_length())


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows of ``x``, filled up with zeros and turned by a fixed orthogonal matrix."""
    width = _width(x.shape[1])
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    rng = np.random.default_rng(width)
    for _ in range(3):
        out *= rng.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            pairs = out.reshape(len(x), -1, 2, step)
            out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(x), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _integers(x: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)``, held where sums of products stay exact."""
    most = np.floor(np.sqrt(MOST / max(1, x.shape[1])))
    return np.clip(np.floor(scale * x), -most, most).astype(np.int64)


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _matrix(column: pa.Array, kind: str, n: int) -> np.ndarray:
    """Rows of a column of equally long binary values."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data if data is not None else b"", np.uint8)[at[0] : at[-1]]
    return data.view(kind).reshape(n, -1)


def _coded(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float)
                q = _integers(values.reshape(part.num_rows, dim), scale)
                turned = rotated(q)
                norm = np.sqrt((turned**2).sum(1))
                code = _words(turned >= 0)
                align = np.abs(turned).sum(1) / np.sqrt(turned.shape[1]) / np.where(norm > 0, norm, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in ("id", "label", "anchor", "dim")),
                        pa.array([r.tobytes() for r in q.astype("<i8")], pa.binary()),
                        pa.array([r.tobytes() for r in code], pa.binary()),
                        pa.array(norm),
                        pa.array(np.where(norm > 0, np.minimum(align, 1), 1.0)),
                    ],
                    ["id", "label", "anchor", "dim", "q", "code", "norm", "align"],
                )

    return run


class Block:
    """Rows with their codes; ``intervals`` bounds their products with anchors."""

    def __init__(self, table: pa.Table) -> None:
        n = table.num_rows
        column = lambda name: table.column(name).combine_chunks()
        self.id, self.label = column("id").to_numpy(), column("label").to_numpy()
        self.q = _matrix(column("q"), "<i8", n)
        self.exact = self.q.astype(float)
        self.code = _matrix(column("code"), "<u8", n)
        self.norm, self.align = column("norm").to_numpy(), column("align").to_numpy()
        self.across = np.sqrt(np.maximum(0, 1 - self.align**2))
        self.ones = np.bitwise_count(self.code).sum(1, dtype=np.int64)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Estimates, and the least and greatest possible scores, of integer anchors (rows)."""
        turned = rotated(anchors)
        width = turned.shape[1]
        step = np.maximum(np.abs(turned).max(1), 1e-300) / TOP
        rounded = np.rint(turned / step[:, None]).astype(np.int64)
        off = np.sqrt(((turned - rounded * step[:, None]) ** 2).sum(1))
        unsigned = rounded + TOP
        inside = np.zeros((len(anchors), len(self.q)), np.int32)
        for p in range(PLANES):
            plane = _words((unsigned >> p) & 1 == 1)
            for w in range(plane.shape[1]):
                inside += np.bitwise_count(plane[:, None, w] & self.code[None, :, w]) * np.int32(1 << p)
        # Signs are twice the bits less one, components the unsigned ones less TOP.
        signed = 2 * inside - unsigned.sum(1)[:, None] - TOP * (2 * self.ones - width)[None, :]
        s = signed * (step / np.sqrt(width))[:, None]
        length = ((rounded * step[:, None]) ** 2).sum(1)
        middle = self.norm * self.align * s
        half = self.norm * (self.across * np.sqrt(np.maximum(0, length[:, None] - s**2)) + off[:, None])
        half += 1e-9 * self.norm * (np.sqrt(length) + off)[:, None] + 1e-6
        return middle, middle - half, middle + half

    def scores(self, anchors: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Integer products of anchors ``a`` and rows ``r``: one product of all anchors with the rows
        that any of them needs, exact in double precision as no partial sum passes 2**53."""
        used = np.zeros(len(self.q), bool)
        used[r] = True
        rows, at = self.exact, r
        if 2 * used.sum() < len(used):
            rows, at = self.exact[used], (np.cumsum(used) - 1)[r]
        return (anchors.astype(float) @ rows.T)[a, at].astype(np.int64)


def _largest(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest finite values of each row."""
    k = min(k, values.shape[1])
    columns = np.argpartition(-values, k - 1, axis=1)[:, :k]
    at = np.repeat(np.arange(len(values)), k)
    columns = columns.ravel()
    fine = values[at, columns] > -np.inf
    return at[fine], columns[fine]


def _first(a: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each anchor by falling score, then id."""
    order = np.lexsort((ids, -score, a))
    begin = np.flatnonzero(np.diff(a[order], prepend=-1))
    rank = np.arange(len(a)) - np.repeat(begin, np.diff(begin, append=len(a)))
    return order[rank < k]


def _kth(a: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """For each of ``n`` anchors its k-th best score, minus infinity where there are fewer."""
    first = _first(a, score, score, k)
    out = np.full(n, np.inf)
    np.minimum.at(out, a[first], score[first])
    out[np.bincount(a[first], minlength=n) < k] = -np.inf
    return out


def best_rows(block: Block, anchors: np.ndarray, barred: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """For each anchor and window (columns of ``low`` and ``high``) the first ``k`` rows with a score
    in it that are not ``barred`` (anchors x rows): anchors, rows, scores of each window.

    Some rows of good estimates give every window a k-th best score; then each row whose interval
    reaches one of these and the windows is scored."""
    middle, least, most = block.intervals(anchors)
    filled = low <= high
    bottom = np.where(filled, low, np.inf).min(1, keepdims=True)
    top = np.where(filled, high, -np.inf).max(1, keepdims=True)
    reach = ~barred & (most >= bottom) & (least <= top)
    guess = np.zeros(reach.shape, bool)
    for w in {0, low.shape[1] - 1}:
        near = np.minimum(middle, 2 * high[:, w, None] - middle)
        guess[_largest(np.where(reach, near, -np.inf), 4 * k)] = True
    a, r = np.nonzero(guess)
    score = block.scores(anchors, a, r)
    need = low.copy()
    for w in range(low.shape[1]):
        here = np.flatnonzero((score >= low[a, w]) & (score <= high[a, w]))
        need[:, w] = np.maximum(low[:, w], _kth(a[here], score[here], len(anchors), k))
    least_need = np.where(filled, need, np.inf).min(1, keepdims=True)
    a, r = np.nonzero(reach & (most >= least_need))
    score = block.scores(anchors, a, r)
    fine = score >= least_need[a, 0]
    a, r, score = a[fine], r[fine], score[fine]
    out = []
    for w in range(low.shape[1]):
        here = np.flatnonzero((score >= need[a, w]) & (score <= high[a, w]))
        here = here[_first(a[here], score[here], block.id[r[here]], k)]
        out.append((a[here], r[here], score[here]))
    return out


FOUND = pa.schema([("anchor_row", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _compare(same_label: bool, k: int, percent: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side")
        home, rows = table.filter(side), table.filter(pc.invert(side))
        if not home.num_rows or not rows.num_rows:
            return FOUND.empty_table()
        block, anchors = Block(rows), Block(home)
        number = home.column("row").to_numpy()
        lists = home.column("scores").to_pylist()
        parts = []
        for at in range(0, len(number), SLICE):
            here = slice(at, at + SLICE)
            n = len(number[here])
            barred = anchors.id[here, None] == block.id[None, :]
            if same_label:
                low, high = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
            else:
                barred |= anchors.label[here, None] == block.label[None, :]
                known = lists[here]
                low, high = np.full((n, max(map(len, known))), np.inf), np.full((n, max(map(len, known))), -np.inf)
                for i, scores in enumerate(known):
                    for j, p in enumerate(scores):
                        low[i, j], high[i, j] = -(-p * percent[0] // 100), p * percent[1] // 100
            for place, (a, r, score) in enumerate(best_rows(block, anchors.q[here], barred, low, high, k)):
                parts.append(
                    pa.table([number[here][a], np.full(len(a), place, np.int32), block.id[r], score], schema=FOUND)
                )
        return pa.concat_tables(parts)

    return run


def _searched(rows: DataFrame, anchors: DataFrame, same_label: bool, k: int, percent, rows_per_block: int, anchors_per_block: int):
    """The first ``k`` of each anchor (and place in its list of scores) over all blocks."""
    part = ["dim", "label"] if same_label else ["dim"]
    of_rows = rows.groupBy(*part).agg(F.ceil(F.count("*") / rows_per_block).alias("n_rows"))
    of_anchors = anchors.groupBy(*part).agg(F.ceil(F.count("*") / anchors_per_block).alias("n_anchors"))
    sizes = of_rows.join(of_anchors, part)
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = [*part, "i", "j", "side", "row", "id", "q", "code", "norm", "align", "scores"] + ["label"] * (not same_label)
    home = anchors.join(sizes, part).withColumn("i", own("n_anchors")).withColumn("j", each("n_rows"))
    other = rows.join(sizes, part).withColumn("j", own("n_rows")).withColumn("i", each("n_anchors"))
    home = home.withColumn("side", F.lit(True))
    other = other.withColumn("side", F.lit(False)).withColumn("scores", F.lit(None).cast("array<long>"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        home.select(*columns)
        .unionByName(other.select(*columns))
        # An explicit number: blocks are small to move and much work, so none are merged.
        .repartition(tasks, *part, "i", "j")
        .groupBy(*part, "i", "j")
        .applyInArrow(_compare(same_label, k, percent), "anchor_row long, place int, id long, score long")
    )
    order = W.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    rows_per_block: int = 4096,
    anchors_per_block: int = 512,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the columns of ``vectors``. An anchor's positives are the first
    ``positives`` other rows of its label by falling score, then id; for each of them come the first
    ``negatives`` rows of other labels whose score is ``percent`` of the positive's score.

    Rows with a null id, label or vector or with a null or non-finite component take no part.
    Equal rows count once, rows of the anchor's id are not its partners, and vectors meet only
    those of their length. Empty and zero vectors score 0. Integers are held where a score stays
    below 2**53 (for 64 components from about 46,000 on at a scale of 256). Of rows with equal
    integers and label only the ``positives`` + 1 of least id can be among the first of anything:
    the others are left out of the comparison, not of the anchors. Writes intermediate tables when called.
    """
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite)
        .withColumn("dim", F.size("vector"))
        .mapInArrow(
            _coded(scale),
            "id long, label long, anchor boolean, dim int, q binary, code binary, norm double, align double",
        )
        .distinct()
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "coded")
    copies = W.partitionBy("label", "q").orderBy("id")
    needed = stored(
        rows.withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= max(positives + 1, negatives))
        .drop("copy", "anchor"),
        "needed",
    )
    anchors = rows.where("anchor").withColumn("scores", F.lit(None).cast("array<long>"))
    sizes = (rows_per_block, anchors_per_block)
    near = _searched(needed, anchors, True, positives, percent, *sizes)
    near = stored(
        near.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near")),
        "positives",
    )
    known = (
        anchors.drop("scores")
        .join(near, F.col("row") == F.col("anchor_row"))
        .withColumn("scores", F.transform("near", lambda p: p["score"]))
    )
    found = _searched(needed, known, False, negatives, percent, *sizes)
    named = known.select("anchor_row", F.col("id").alias("anchor_id"), "near")
    positive = F.element_at("near", F.col("place") + 1)
    return found.join(named, "anchor_row").select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
