"""Near-duplicate documents by a grouped prefix join on word shingles.

Shingles have one global order, rare ones first. Every task counts the shingles it meets several
times; summed over tasks these counts give the frequent shingles, of which the ``MOST_FREQUENT``
commonest are shipped with their frequency and come last, by frequency, so that lines in very many
documents stay out of the prefixes. Any order is right, a good one makes few candidates. Two
sets with Jaccard similarity of at least ``share`` have a shingle of their prefixes in common.

A set also has a bitmap, the parity of its shingles in ``BITS`` places: two sets differ in as many
shingles at least as their bitmaps in bits, which rules out most pairs that are not similar
enough before any text is moved.

Documents of equal sets are one node; nodes of equal prefix and size are one group, and only
groups are joined. First every group meets the least and the greatest group of each of its
prefix shingles, which links a family of any size by as many pairs as rows. Then, for shingles
whose nodes still belong to several components, all nodes outside the largest component meet
all nodes of other components. Every pair is verified on the full sets of its texts, so links
within a component that is already known are the only ones not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.components import components
from quern.llm.hashing import BYTE_LOWER, Texts, mixed, of_grams, of_ranges, prefix_sums, signed, texts, words
from quern.llm.tables import field, keyed, stored

MOST_FREQUENT = 1 << 20
COUNTED = 1 << 22  # shingles that a task counts at once
IN_TASK, IN_ALL = 3, 8  # least counts, in a task and over all, of a shingle that is called frequent
BITS = 512
MAPS = [f"m{i}" for i in range(BITS // 64)]


def shingles(t: Texts, size: int) -> list[np.ndarray]:
    """For each text the hashes of its runs of ``size`` words, or of all its words if fewer."""
    w = words(t, BYTE_LOWER)
    grams = of_grams(w.hashes, size) if len(w.hashes) >= size else w.hashes[:0]
    sums = prefix_sums(w.hashes) if len(w.hashes) else None
    found = []
    for a, b in zip(w.start.tolist(), w.end.tolist()):
        if b - a >= size:
            found.append(grams[a : b - size + 1])
        elif b > a:
            few = of_ranges(sums, np.array([a]), np.array([b]))
            found.append(mixed(few + np.uint64(b - a)))
        else:
            found.append(grams[:0])
    return found


def _repeated(parts: list[np.ndarray]) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(parts), return_counts=True)
    often = n >= IN_TASK
    return pa.RecordBatch.from_arrays([pa.array(signed(values[often])), pa.array(n[often])], ["shingle", "n"])


def _count(text_col: str, size: int):
    """The shingles that a task meets several times, and how often; in parts of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for t in texts(field(batch, text_col)):
                parts += [np.unique(s) for s in shingles(t, size)]
                n += sum(len(s) for s in parts[-len(t.start) :])
                if n >= COUNTED:
                    yield _repeated(parts)
                    parts, n = [], 0
        if parts:
            yield _repeated(parts)

    return run


Frequent = tuple[np.ndarray, np.ndarray]


def frequent(counts: pa.Table) -> Frequent:
    """Frequent shingles in ascending order, and a number that ascends with their frequency."""
    values = counts.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], counts.column("band").to_numpy()[order].astype(np.uint64)


def _commonest(texts_of: DataFrame, text_col: str, size: int) -> pa.Table:
    """``(shingle, band)`` of at most ``MOST_FREQUENT`` shingles, whole bands of frequency from the top."""
    counted = texts_of.mapInArrow(_count(text_col, size), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    band = F.least(F.floor(2 * F.log2("n")), F.lit(63)).cast("int")
    counted = stored(counted.where(F.col("n") >= IN_ALL).select("shingle", band.alias("band")), "frequent")
    least, room = 64, MOST_FREQUENT
    for b, n in sorted(counted.groupBy("band").count().collect(), reverse=True):  # at most 64 rows
        if n > room:
            break
        least, room = b, room - n
    return counted.where(F.col("band") >= least).toArrow().combine_chunks()


def ordered(s: np.ndarray, known: Frequent) -> np.ndarray:
    """The different shingles as numbers that ascend in the global order."""
    values, band = known
    place = np.zeros(len(s), np.uint64)
    if len(values):
        at = np.minimum(np.searchsorted(values, s), len(values) - 1)
        place = np.where(values[at] == s, band[at], place)
    return np.unique((place << np.uint64(58)) | (s >> np.uint64(6)))


def bitmap(s: np.ndarray) -> np.ndarray:
    """In how many places of ``BITS`` the number of shingles is odd, as signed words."""
    odd = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefix(s: np.ndarray, percent: int) -> np.ndarray:
    """The least of an ordered set, of which a set that similar has one at least."""
    return s[: len(s) - (-(-percent * len(s) // 100)) + 1] if len(s) else s


def _of_prefix(first: np.ndarray, n: int) -> np.int64:
    """A number for prefix and size."""
    return signed(mixed(first.sum(keepdims=True)) ^ np.uint64(n))[0]


def _prefixes(shipped, text_col: str, size: int, percent: int):
    """(group, shingle) rows of every group, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shipped.value, set()
        for batch in batches:
            for t in texts(field(batch, text_col)):
                groups, parts = [], []
                for s in shingles(t, size):
                    s = ordered(s, known)
                    first = _prefix(s, percent)
                    group = _of_prefix(first, len(s)) if len(s) else None
                    if group is not None and group not in seen:
                        seen.add(group)
                        groups.append(group)
                        parts.append(first)
                if groups:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array(groups, np.int64), [len(x) for x in parts])),
                            pa.array(signed(np.concatenate(parts))),
                        ],
                        ["grp", "token"],
                    )

    return run


def _sketch(shipped, text_col: str, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            n, node, group, maps = [], [], [], []
            for t in texts(field(batch, text_col)):
                for s in shingles(t, size):
                    s = ordered(s, known)
                    both = np.array([s.sum(), np.bitwise_xor.reduce(s) if len(s) else 0], np.uint64)
                    one, two = mixed(both + np.uint64(len(s)))
                    n.append(len(s))
                    node.append(one ^ mixed(np.array([two]))[0])
                    group.append(_of_prefix(_prefix(s, percent), len(s)))
                    maps.append(bitmap(s))
            maps = np.array(maps, np.int64).reshape(len(n), len(MAPS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("id"),
                    pa.array(np.array(n, np.int32)),
                    pa.array(signed(np.array(node, np.uint64))),
                    pa.array(np.array(group, np.int64)),
                    *(pa.array(maps[:, i]) for i in range(len(MAPS))),
                ],
                ["key", "id", "n", "node", "grp", *MAPS],
            )

    return run


def _pack(text_col: str):
    """Texts are moved several times; packed they take less than half the room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress((t or "").encode(), 1) for t in field(batch, text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(packed, pa.binary())], ["key", "body"])

    return run


def _set_of(body: bytes, size: int) -> np.ndarray:
    return np.unique(next(iter(shingles(next(texts(pa.array([zlib.decompress(body)]))), size))))


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, have = None, None
        for batch in batches:
            linked = []
            for a, b, body_a, body_b in zip(*(batch.column(c) for c in ("a", "b", "body_a", "body_b"))):
                if b != of:
                    of, have = b, _set_of(body_b.as_py(), size)
                mine = _set_of(body_a.as_py(), size)
                both = len(np.intersect1d(mine, have, assume_unique=True))
                linked.append(100 * both >= percent * (len(mine) + len(have) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _least_shared(a: Column, b: Column, percent: int) -> Column:
    """How many shingles the prefixes of sets of sizes ``a`` and ``b`` share at least, if the
    sets are similar: of the first shingles of either, all but those the other lacks."""
    overlap = F.ceil((a + b) * percent / F.lit(100 + percent) - F.lit(1e-9))
    return overlap + 1 - F.ceil(F.greatest(a, b) * percent / F.lit(100) - F.lit(1e-9))


def _near_in_bits(percent: int) -> Column:
    """Whether the bitmaps ``m.._a`` and ``m.._b`` differ in no more bits than similar sets of sizes
    ``n_a`` and ``n_b`` can differ in shingles."""
    both = F.col("n_a") + F.col("n_b")
    overlap = F.ceil(both * percent / F.lit(100 + percent) - F.lit(1e-9))
    differing = sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in MAPS), F.lit(0))
    return differing <= both - 2 * overlap


def _maps(side: str, of: str = "") -> list[Column]:
    return [F.col(f"{of}{m}").alias(f"{m}_{side}") for m in MAPS]


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``key`` (see ``tables.keyed``), ``id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents link when the Jaccard similarity of their sets of ``shingle``-word runs (lower
    case A-Z) is at least ``percent`` in a hundred; a component is what links reach, named by
    its smallest id. A text with fewer words is one shingle; null and empty texts have none,
    link with nothing and are kept. ``kept`` marks the row of smallest id (null first), and
    among rows of that id the one of smallest key; repeated rows share it. Writes intermediate
    tables when called.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    texts_of = rows.select("key", F.struct(F.col("row")[text_col].alias(text_col)).alias("row"), F.col("row")[id_col].alias("id"))
    shipped = spark.sparkContext.broadcast(frequent(_commonest(texts_of, text_col, shingle)))
    id_type = docs.schema[id_col].dataType.simpleString()
    sketch = stored(
        texts_of.mapInArrow(
            _sketch(shipped, text_col, shingle, percent),
            f"key long, id {id_type}, n int, node long, grp long, " + ", ".join(f"{m} long" for m in MAPS),
        ),
        "sketch",
    )
    nodes = stored(
        sketch.where("n > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct("id", "key")).alias("first"), F.min("n").alias("n"),
            F.min("grp").alias("grp"), F.min("key").alias("key"), *[F.min(m).alias(m) for m in MAPS],
        ),
        "nodes",
    )
    prefixes = texts_of.select("row").mapInArrow(_prefixes(shipped, text_col, shingle, percent), "grp long, token long")
    same = Window.partitionBy("token")
    shared = stored(
        prefixes.select("token", "grp", F.min("grp").over(same).alias("least"), F.max("grp").over(same).alias("most"))
        .where("least <> most")
        .distinct(),
        "shared",
    )
    heads = nodes.groupBy("grp").agg(F.min(F.struct("node", "n", *MAPS)).alias("head"), F.count("*").alias("members"))
    met = (
        shared.select("grp", F.explode(F.array("least", "most")).alias("other"))
        .where("grp <> other")
        .groupBy("grp", "other")
        .agg(F.count("*").alias("seen"))
        .unionByName(heads.where("members > 1").select("grp", F.col("grp").alias("other"), F.lit(None).alias("seen")))
    )
    of = nodes.select("grp", F.col("node").alias("a"), F.col("n").alias("n_a"), *_maps("a"))
    # A pair sharing few of the shingles counted here is left to the second part, which counts all.
    promising = F.col("seen").isNull() | (F.col("seen") * 8 >= _least_shared(F.col("n_a"), F.col("n_b"), percent))
    stars = stored(
        met.join(of, "grp")
        .join(heads.select(F.col("grp").alias("other"), F.col("head.node").alias("b"), F.col("head.n").alias("n_b"), *_maps("b", "head.")), "other")
        .where(_near_in_size(F.col("n_a"), F.col("n_b"), percent) & (F.col("a") != F.col("b")) & promising & _near_in_bits(percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "pairs",
    )
    crowds = heads.where("members > 1").select("grp")
    wanted = nodes.join(shared.select("grp").unionByName(crowds).distinct(), "grp", "left_semi").select("key", "node")
    packed = texts_of.select("key", "row").mapInArrow(_pack(text_col), "key long, body binary")
    bodies = stored(wanted.join(packed, "key").select("node", "body"), "bodies")

    def verified(pairs: DataFrame) -> DataFrame:
        """Each text is sent once to every pair it is in; a pair is its own group of two."""
        sides = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(True).alias("first")), F.struct(F.col("b").alias("node"), F.lit(False).alias("first"))))
        sent = pairs.select("a", "b", sides.alias("s")).select("a", "b", "s.*").join(bodies, "node")
        both = sent.groupBy("a", "b").agg(
            F.max(F.when(F.col("first"), F.col("body"))).alias("body_a"), F.max(F.when(~F.col("first"), F.col("body"))).alias("body_b")
        )
        return both.mapInArrow(_verify(shingle, percent), "a long, b long")

    links = stored(verified(stars), "verified")
    root = components(links)
    # What the stars left apart: shingles (or groups) with nodes of several components.
    tokens = shared.select("token", "grp", F.lit(False).alias("crowd")).unionByName(
        crowds.select(F.col("grp").alias("token"), "grp", F.lit(True).alias("crowd"))
    )
    labelled = nodes.select("grp", "node", "n", *MAPS).join(root, "node", "left").select(
        "grp", "node", "n", *MAPS, F.coalesce("root", "node").alias("root")
    )
    placed = tokens.join(labelled, "grp").select("token", "crowd", "node", "n", *MAPS, "root")
    by_root = placed.groupBy("token", "crowd", "root").agg(F.count("*").alias("size"))
    open_ = by_root.groupBy("token", "crowd").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.count("*").alias("roots"))
    left = stored(placed.join(open_.where("roots > 1"), ["token", "crowd"]).select("token", "crowd", "node", "n", *MAPS, "root", "largest"), "open")
    few = left.where("root <> largest").select("token", "crowd", "largest", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"), *_maps("a"))
    many = left.select("token", "crowd", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), *_maps("b"))
    # Every shingle that a pair of different components shares is met here, each once.
    once = (F.col("root_b") == F.col("largest")) | (F.col("a") < F.col("b"))
    rest = (
        few.join(many, ["token", "crowd"])
        .where(
            (F.col("root_a") != F.col("root_b")) & once & _near_in_size(F.col("n_a"), F.col("n_b"), percent) & _near_in_bits(percent)
        )
        .select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "crowd",
            _least_shared(F.col("n_a"), F.col("n_b"), percent).alias("needed"),
        )
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.max("needed").alias("needed"), F.max("crowd").alias("crowd"))
        .where("n >= needed or crowd")
        .select("a", "b")
    )
    more = stored(verified(rest.join(stars, ["a", "b"], "left_anti")), "verified")
    root = components(links.unionByName(more))
    labelled = nodes.select("node", "first").join(root, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")
    )
    names = labelled.groupBy("root").agg(F.min("first").alias("name"))
    named = labelled.join(names, "root").select("node", "name")
    own = F.struct("id", "key")
    return sketch.drop("grp", *MAPS).join(named, "node", "left").select(
        "key",
        "id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name.id")).otherwise(F.col("id")).alias("component_id"),
        ((F.col("n") == 0) | own.eqNullSafe(F.col("name"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` of which ``kept`` holds; of repeated rows one."""
    kept = near_duplicate_classes(docs, id_col, text_col, **options).where("kept").select("key").distinct()
    return keyed(docs, id_col, text_col).join(kept, "key").dropDuplicates(["key"]).select("row.*")
