"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | context) = P(class | context) x P(word | class). The class of a word comes from its
last two bytes; the softmax over classes has three hashed features of the context: the word
before, the two words before, and, skipping one, the second word before.

Within a class there is a softmax over its words, too: it starts from their add-one share, with one
place for all unknown words, and has a feature for every pair of a word and the word before that
the training texts hold. A weight is such that the model expects the pair as often as it was met less
``DISCOUNT``; as each context has features of single words only, this has a closed form, and so has
the sum that makes the chances of a context add up to one, the weight of the context itself. There is
one such weight per different pair and per different context, so they grow with the corpus.

Learning sums over all training texts: token counts; how often features and classes meet; and
in each round, how often the model expects them to meet, from which the weights follow the
gradient, scaled by both. Sums are taken per task, then in a tree of partial sums of fixed size.
Pairs are counted per task and dealt out by context.

Counts of the most frequent tokens, at most ``most_frequent``, and weights of the most frequent pairs
and contexts, at most ``most_features``, are shipped to the tasks that score; those of all others are
joined. Tokens, pairs and contexts are known by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.hashing import BYTE_LOWER, Texts, mixed, signed, texts, words
from quern.llm.tables import field, stored
from quern.sources.files import shuffle_parts

CLASSES = 32
BITS = 12
FEATURES = 3
END, START = np.uint64(0x51ED270B153A4D2F), np.uint64(0x2545F4914F6CDD1D)
HELD = 4_000_000  # tokens a task holds before it counts them
SHAPE = (FEATURES, 1 << BITS, CLASSES)
PIECE = 1 << 14  # tokens whose chances are computed at once; they fit the cache
DISCOUNT = 0.75


@dataclass
class Tokens:
    """Tokens of some texts: hash, class, hash of the token before with the class (the context within the
    class), buckets of the features, and where texts start and end."""

    hashes: np.ndarray
    classes: np.ndarray
    contexts: np.ndarray
    buckets: list[np.ndarray]
    start: np.ndarray
    end: np.ndarray


def tokens(t: Texts) -> Tokens:
    w = words(t, BYTE_LOWER)
    n = len(t.start)
    fold = t.data | ((t.data >= 65) & (t.data <= 90)).astype(np.uint8) * np.uint8(32)
    last = fold[w.high - 1].astype(np.int64)
    second = np.where(w.high - w.low > 1, fold[np.maximum(w.high - 2, 0)], 0).astype(np.int64)
    kinds = 1 + (last * 31 + second * 7 + (last * second) // 64) % (CLASSES - 1)
    hashes = np.insert(w.hashes, w.end, END)
    kinds = np.insert(kinds, w.end, 0)
    end = w.end + np.arange(1, n + 1)
    start = np.concatenate(([0], end[:-1]))
    back = np.empty_like(hashes)
    back[1:], back[start] = hashes[:-1], START
    two = np.empty_like(hashes)
    two[1:] = back[:-1]
    two[start] = START
    shift = np.uint64(64 - BITS)
    pair = mixed(back + two * np.uint64(0x9E3779B97F4A7C15))
    buckets = [(x >> shift).astype(np.uint16) for x in (back, pair, mixed(two))]
    contexts = mixed(back * np.uint64(0xD6E8FEB86659FD93) + kinds.astype(np.uint64))
    return Tokens(hashes, kinds, contexts, buckets, start, end)


def pairs(contexts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of tokens with their contexts."""
    return mixed(contexts * np.uint64(0x9E3779B97F4A7C15) + hashes)


def _counted(held: list[np.ndarray], kinds: list[np.ndarray]) -> pa.RecordBatch:
    h, first, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(h)), pa.array(np.concatenate(kinds)[first].astype(np.int32)), pa.array(n)],
        ["token", "kind", "n"],
    )


def _count_tokens(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kinds, size = [], [], 0
        for batch in batches:
            for t in texts(field(batch, text_col)):
                k = tokens(t)
                held.append(k.hashes)
                kinds.append(k.classes.astype(np.uint8))
                size += len(k.hashes)
                if size >= HELD:
                    yield _counted(held, kinds)
                    held, kinds, size = [], [], 0
        if held:
            yield _counted(held, kinds)

    return run


def _counted_pairs(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    contexts, hashes = (np.concatenate(c) for c in zip(*held))
    _, first, n = np.unique(pairs(contexts, hashes), return_index=True, return_counts=True)
    columns = [signed(contexts[first]), signed(hashes[first]), n.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["context", "token", "n"])


def _count_pairs(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for t in texts(field(batch, text_col)):
                k = tokens(t)
                held.append((k.contexts, k.hashes))
                size += len(k.hashes)
                if size >= HELD:
                    yield _counted_pairs(held)
                    held, size = [], 0
        if held:
            yield _counted_pairs(held)

    return run


def _found(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``h`` in the ascending ``known``, and whether they are there."""
    if not len(known):
        return np.zeros(len(h), np.intp), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return at, known[at] == h


def _weigh(shipped):
    """Weights of pairs and contexts from counts of pairs, of which all of a context are in one task.

    Without the share of its token within the class, a pair has no weight yet: then ``ratio`` is
    what the discounted count has over what is left for all words of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(c).to_numpy() for c in ("context", "token", "n")] for b in batches]
        if not parts:
            return
        context, token, n = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort((token, context))
        context, token, n = context[order], token[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.diff(context, prepend=~context[0]) | np.diff(token, prepend=~token[0]))
        context, token, n = context[first], token[first], np.add.reduceat(n, first)
        opens = np.flatnonzero(np.diff(context, prepend=~context[0]))
        different = np.diff(opens, append=len(context))
        total = np.add.reduceat(n, opens)
        left = DISCOUNT * different / total
        ratio = (n - DISCOUNT) / np.repeat(total * left, different)
        known, share = shipped.value
        at, found = _found(known, token)
        weight = np.full(len(n), np.nan)
        weight[found] = np.log10(ratio[found] / share[at[found]] + 1)
        feature = signed(pairs(context.view(np.uint64), token.view(np.uint64)))
        for low in range(0, len(n), HELD):
            some = slice(low, low + HELD)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(feature[some]),
                    pa.array(n[some]),
                    pa.array(weight[some].astype(np.float32), from_pandas=True),
                    pa.array(token[some], mask=found[some]),
                    pa.array(ratio[some], mask=found[some]),
                ],
                ["feature", "n", "weight", "token", "ratio"],
            )
        nothing = pa.nulls(len(opens), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(context[opens]), pa.array(total), pa.array(np.log10(left).astype(np.float32)), nothing, nothing.cast(pa.float64())],
            ["feature", "n", "weight", "token", "ratio"],
        )

    return run


def _table(sums: np.ndarray) -> pa.RecordBatch:
    """Partial sums travel in single precision."""
    return pa.RecordBatch.from_arrays([pa.array([sums.astype(np.float32).tobytes()], pa.binary())], ["sums"])


def _meet(text_col: str):
    """How often buckets and classes meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SHAPE)
        for batch in batches:
            for t in texts(field(batch, text_col)):
                k = tokens(t)
                for f in range(FEATURES):
                    cells = k.buckets[f].astype(np.int64) * CLASSES + k.classes
                    sums[f] += np.bincount(cells, minlength=sums[f].size).reshape(SHAPE[1:])
        yield _table(sums)

    return run


def _pieces(weights: np.ndarray, k: Tokens) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray]]:
    """P(class | context) of every token, some tokens at a time: which ones, their buckets, a row per
    class. ``weights`` has a row of buckets per class, so that all steps run along whole rows."""
    for at in range(0, len(k.classes), PIECE):
        some = slice(at, min(at + PIECE, len(k.classes)))
        buckets = [b[some].astype(np.intp) for b in k.buckets]
        z = np.empty((CLASSES, some.stop - at), np.float32)
        more = np.empty_like(z[0])
        for c in range(CLASSES):
            np.take(weights[0, c], buckets[0], out=z[c], mode="clip")
            for f in range(1, FEATURES):
                np.take(weights[f, c], buckets[f], out=more, mode="clip")
                z[c] += more
        z -= z.max(axis=0)
        np.exp(z, out=z)
        z /= z.sum(axis=0)
        yield some, buckets, z


def _by_class(weights: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(weights.transpose(0, 2, 1))


def _chances(weights: np.ndarray, k: Tokens) -> np.ndarray:
    """P(class | context) of every token, a row per token."""
    return np.concatenate([p for *_, p in _pieces(_by_class(weights), k)], axis=1).T


def _expect(shipped, text_col: str):
    """How often the model expects buckets and classes to meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _by_class(shipped.value)
        sums = np.zeros(weights.shape)
        for batch in batches:
            for t in texts(field(batch, text_col)):
                for _, buckets, p in _pieces(weights, tokens(t)):
                    for c in range(CLASSES):
                        chance = p[c].astype(np.float64)
                        for f in range(FEATURES):
                            sums[f, c] += np.bincount(buckets[f], chance, 1 << BITS)
        yield _table(sums.transpose(0, 2, 1))

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(SHAPE)
    for batch in batches:
        for b in batch.column("sums"):
            sums += np.frombuffer(b.as_buffer(), np.float32).reshape(SHAPE)
    yield _table(sums)


def tree_sum(parts: DataFrame) -> np.ndarray:
    """The sum of tables, one per task: each level of the tree has the root of its tasks."""
    width = parts.rdd.getNumPartitions()
    while width > 8:
        width = max(1, round(width**0.5))
        parts = parts.repartition(width).mapInArrow(_add, "sums binary")
    sums = np.zeros(SHAPE)
    for row in parts.collect():  # at most eight tables of fixed size
        sums += np.frombuffer(row["sums"], np.float32).reshape(SHAPE)
    return sums


@dataclass
class Model:
    """``counts``: a table (token, kind, n). ``within``: what the share of a word within its
    class has over its share of all words, as log10. ``lookup``: a table (key, value, known) of what
    is not shipped: log10 of counts and one of tokens, known 1, and weights of features, known 0."""

    weights: np.ndarray
    within: np.ndarray
    n: int
    different: int
    frequent: tuple[np.ndarray, np.ndarray]
    features: tuple[np.ndarray, np.ndarray]
    lookup: DataFrame


def _least_frequent(counts: DataFrame, most: int) -> int:
    """The least count, of steps of about an eighth, that at most ``most`` tokens reach."""
    step = F.floor(F.log2("n") * 6).alias("step")
    steps = counts.groupBy(step).agg(F.min("n").alias("least"), F.max("n").alias("greatest"), F.count("*").alias("tokens"))
    limit, reach = 1, 0
    for r in steps.orderBy(F.desc("step")).collect():  # at most six steps per binary digit
        reach += r["tokens"]
        if reach > most:
            return r["greatest"] + 1
        limit = r["least"]
    return limit


def word_features(
    docs: DataFrame, text_col: str, counts: DataFrame, limit: int, within: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """``(feature, n, weight)`` of every pair of tokens and every context; writes an intermediate table.

    ``within`` has the places of words in each class, ``frequent`` ascending tokens with their share
    within their class, those of ``counts`` that are met ``limit`` times."""
    shipped = docs.sparkSession.sparkContext.broadcast(frequent)
    rows = docs.select(F.struct(F.col(text_col).alias(text_col)).alias("row"))
    # An explicit number: a task holds the counts of its contexts.
    parts = shuffle_parts(docs)
    found = stored(
        rows.mapInArrow(_count_pairs(text_col), "context long, token long, n int")
        .repartition(parts, "context")
        .mapInArrow(_weigh(shipped), "feature long, n long, weight float, token long, ratio double"),
        "features",
    )
    places = F.element_at(F.array(*[F.lit(float(p)) for p in within]), F.col("kind") + 1)
    rare = counts.where(F.col("n") < limit).select("token", ((F.col("n") + 1) / places).alias("share"))
    weighed = F.log10(F.col("ratio") / F.col("share") + 1).cast("float").alias("weight")
    late = found.where(F.col("token").isNotNull()).join(rare, "token").select("feature", "n", weighed)
    return found.where(F.col("token").isNull()).select("feature", "n", "weight").unionAll(late)


def train(
    docs: DataFrame, text_col: str = "text", rounds: int = 2, most_frequent: int = 250_000, most_features: int = 1_000_000
) -> Model:
    """Learn from all texts of ``docs``. Writes tables of counts and features when called."""
    rows = docs.select(F.struct(F.col(text_col).alias(text_col)).alias("row"))
    counts = stored(
        rows.mapInArrow(_count_tokens(text_col), "token long, kind int, n long")
        .groupBy("token")
        .agg(F.min("kind").alias("kind"), F.sum("n").alias("n")),
        "counts",
    )
    per_class = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    size, different = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        size[r["kind"]], different[r["kind"]] = r["n"], r["v"]
    n, v = int(size.sum()), int(different.sum())
    limit = _least_frequent(counts, most_frequent)
    frequent = counts.where(F.col("n") >= limit).select("token", "kind", "n").toArrow()  # at most most_frequent
    token, kind, count = (frequent.column(c).to_numpy() for c in ("token", "kind", "n"))
    order = np.argsort(token)
    token, kind, count = token[order], kind[order], count[order]
    places = size + different + 1
    features = word_features(docs, text_col, counts, limit, places, (token, (count + 1) / places[kind]))
    reach = _least_frequent(features, most_features)
    shipped = features.where(F.col("n") >= reach).select("feature", "weight").toArrow()  # at most most_features
    feature, weight = shipped.column("feature").to_numpy(), shipped.column("weight").to_numpy()
    order = np.argsort(feature)
    feature, weight = feature[order], weight[order]
    rare = counts.where(F.col("n") < limit)
    lookup = rare.select(F.col("token").alias("key"), F.log10(F.col("n") + 1.0).alias("value"), F.lit(1).alias("known"))
    lookup = lookup.unionAll(
        features.where(F.col("n") < reach).select("feature", F.col("weight").cast("double"), F.lit(0))
    )
    met = tree_sum(rows.mapInArrow(_meet(text_col), "sums binary"))
    # The first guess has half of what each feature alone says.
    share = np.log((size + 1) / (n + CLASSES))
    alone = np.log((met + 4 * np.exp(share)) / (met.sum(axis=2, keepdims=True) + 4))
    weights = (alone - share) * 0.5
    weights[0] += share
    for _ in range(rounds):
        shipped = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
        expected = tree_sum(rows.mapInArrow(_expect(shipped, text_col), "sums binary"))
        weights += 2 / FEATURES * (met - expected) / (met + expected + 5)
        shipped.unpersist()
    within = np.log10(n + v + 1) - np.log10(places)
    return Model(weights.astype(np.float32), within, n, v, (token, count), (feature, weight), lookup)


def _score(shipped, text_col: str):
    rare_type = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, within, known, count, features, weight = shipped.value
        weights = _by_class(weights)
        logs = np.log10(count + 1.0)
        for batch in batches:
            parts, keys_of, times_of = [], [], []
            for t in texts(field(batch, text_col)):
                k = tokens(t)
                p = np.empty(len(k.classes), np.float32)
                for some, _, z in _pieces(weights, k):
                    p[some] = z[k.classes[some], np.arange(z.shape[1])]
                gain = np.log10(np.maximum(p, 1e-30)) + within[k.classes]
                h = signed(k.hashes)
                at, found = _found(known, h)
                base = np.where(found, logs[at], 0.0) if len(known) else np.zeros(len(h))
                rest = [(~found, h)]
                for key in (signed(k.contexts), signed(pairs(k.contexts, k.hashes))):
                    at, there = _found(features, key)
                    if len(features):
                        gain += np.where(there, weight[at], 0.0)
                    rest.append((~there, key))
                sums = [np.add.reduceat(x, k.start) for x in (gain, base, found.astype(np.int64))]
                # The other tokens, contexts and pairs of each text, each once with its number.
                of = np.repeat(np.arange(len(k.start)), k.end - k.start)
                of, key = (np.concatenate(c) for c in zip(*((of[other], key[other]) for other, key in rest)))
                order = np.lexsort((key, of))
                key, of = key[order], of[order]
                first = np.flatnonzero((np.diff(key, prepend=0) != 0) | (np.diff(of, prepend=-1) != 0))
                keys_of.append(key[first])
                times_of.append(np.diff(first, append=len(key)).astype(np.int32))
                parts.append((k.end - k.start, *sums, np.bincount(of[first], minlength=len(k.start))))
            if not parts:
                continue
            *numbers, lengths = (np.concatenate(c) for c in zip(*parts))
            rare = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(keys_of), pa.int64()), pa.array(np.concatenate(times_of))], ["key", "times"]
            )
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("place"),
                    *(pa.array(c) for c in numbers),
                    pa.ListArray.from_arrays(pa.array(offsets), rare).cast(rare_type),
                ],
                ["id", "place", "n_tokens", "gain", "base", "known", "rare"],
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of each row.

    ``score`` is the model's log10 probability of the text with its end, ``base_score`` that of
    the add-one shares of its words. Null and empty texts have one token, the end. Repeated rows
    have equal scores. Writes an intermediate table when called.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.within, *model.frequent, *model.features))
    rows = docs.select(
        F.struct(F.col(text_col).alias(text_col)).alias("row"), F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("place"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    # A table, so that the number of a row stays the same.
    parts = stored(
        rows.mapInArrow(
            _score(shipped, text_col),
            f"id {id_type}, place long, n_tokens long, gain double, base double, known long, "
            "rare array<struct<key: long, times: int>>",
        ),
        "scores",
    )
    rare = (
        parts.select("place", F.explode("rare").alias("r"))
        .select("place", "r.key", "r.times")
        .join(model.lookup, "key")
        .groupBy("place")
        .agg(
            F.sum(F.col("times") * F.col("known") * F.col("value")).alias("rare_base"),
            F.sum(F.col("times") * (1 - F.col("known")) * F.col("value")).alias("rare_gain"),
            F.sum(F.col("times") * F.col("known")).alias("rare_known"),
        )
    )
    every = float(np.log10(model.n + model.different + 1))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(every)
    return parts.drop("rare").join(rare, "place", "left").select(
        "id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain") + F.coalesce("rare_gain", F.lit(0.0))).alias("score"),
    )


def held_out(id_col: Column, modulus: int = 7, remainder: int = 2) -> Column:
    """Whether a row is kept from training, by its id alone; a null id is as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
