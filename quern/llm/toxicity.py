"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

One weight per feature serves all grades: P(grade >= k) = sigmoid(score - threshold k), with
ascending thresholds; the expected severity is the sum of these over k. Features are the
different words of a text and the first four and five letters of each, hashed.

The classifier is fitted on a bounded sample, ``most_texts`` labelled texts (clean, toxic), the
first of each by hash of their ids; every text of the table is scored. Features as rare as three
texts of the sample count. The decision threshold is moved where a fifth of the sample, held out of
a first fit, has fewer errors that way; the model itself is fitted on all of the sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.tables import columns, field, stored, table_schema

BUCKETS = 1 << 20
CACHED = 400_000
OUT = columns(severity="double", grade="int", p_toxic="double")
OUT_ARROW = to_arrow_type(OUT)
_LETTERS = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[int, ...]:
    """Buckets of a word and its beginnings."""
    names = [word] if len(word) < 6 else [word, "^" + word[:5]]
    if len(word) > 4:
        names.append("^" + word[:4])
    return tuple(zlib.crc32(n.encode()) % BUCKETS for n in names)


def different_words(text: str | None) -> set[str]:
    return set(_LETTERS.findall((text or "").lower()))


@dataclass
class Ordinal:
    """Weights of selected features and thresholds in ascending order."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), a column for each k from 1."""
        z = np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)
        return 1 / (1 + np.exp(-z))


def dose_grades(toxic: np.ndarray, doses: np.ndarray, cuts: tuple[int, ...] = (2, 5)) -> np.ndarray:
    """Grades from two-valued labels: 0 where not toxic, else 1 and one more for every cut that
    the number of telling words exceeds."""
    return toxic * (1 + sum((doses > c).astype(int) for c in cuts))


def telling(sample: DataFrame, n: int, n_bad: int, most: int) -> DataFrame:
    """``(bucket, odds)`` of the features whose frequencies differ most between the classes."""
    counts = (
        sample.select((F.col("toxic") > 0).cast("int").alias("bad"), F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("all"), F.sum("bad").alias("bad"))
        .where("all >= 3")
    )
    p, q = (F.col("bad") + 0.5) / (n_bad + 1), (F.col("all") - F.col("bad") + 0.5) / (n - n_bad + 1)
    strength = F.abs(F.col("odds")) * F.abs(p - q) * float(np.sqrt(n))
    rated = counts.withColumn("odds", F.log(p / q)).withColumn("strength", strength)
    return rated.where("strength > 0.5 and abs(odds) > 1").orderBy(F.desc("strength"), "bucket").limit(most)


def fit(
    rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, chosen: np.ndarray, levels: int,
    ridge: float = 0.02, steps: int = 900,
) -> Ordinal:
    """Weights and thresholds of least penalised negative log likelihood, by Adam."""
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[cols] >= 0
    r, c = rows[inside], place[cols[inside]]
    n, k = len(grades), levels - 1
    theta = np.zeros(len(chosen) + k)
    theta[-k:] = 0.5
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:-k], theta[-k:]
        cuts = gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))
        s = np.bincount(r, w[c], n)
        above = 1 / (1 + np.exp(-np.clip(s[:, None] - cuts[None, :], -40, 40)))
        full = np.hstack((np.ones((n, 1)), above, np.zeros((n, 1))))
        at = np.arange(n)
        low, high = full[at, grades], full[at, grades + 1]
        p = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low) / p, -high * (1 - high) / p
        slope = (d_low + d_high) / n  # of the log likelihood by score
        by_cut = np.zeros((n, k + 2))
        by_cut[at, grades] -= d_low
        by_cut[at, grades + 1] -= d_high
        by_cut = by_cut[:, 1:-1].sum(axis=0) / n
        gradient = np.empty_like(theta)
        gradient[:-k] = -np.bincount(c, slope[r], len(chosen)) + ridge * w / n
        later = np.cumsum(by_cut[::-1])[::-1]
        gradient[-k] = -later[0]
        gradient[len(theta) - k + 1 :] = -later[1:] * np.exp(gaps[1:])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    gaps = theta[-k:]
    cuts = gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))
    return Ordinal(dict(zip(chosen.tolist(), theta[:-k].tolist())), cuts)


def shift(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The decision threshold with fewest errors, of these the one nearest to 0."""
    known = np.unique(scores)
    cuts = np.concatenate(([0.0], (known[1:] + known[:-1]) / 2))
    missed = np.searchsorted(np.sort(scores[toxic]), cuts)
    alarms = (~toxic).sum() - np.searchsorted(np.sort(scores[~toxic]), cuts)
    return float(cuts[np.lexsort((np.abs(cuts), missed + alarms))[0]])


def _sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str, most: tuple[int, int]
) -> DataFrame:
    """At most ``most`` clean and toxic texts, the first of each by hash of the id."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(toxic_col).alias("toxic"))
    first = [
        known.where(kind).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(n)
        for kind, n in zip(("toxic = 0", "toxic > 0"), most)
    ]
    some = first[0].unionByName(first[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(some), "id").select("id", "toxic", "text")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            sorted({b for w in different_words(t) for b in features(w)})
            for t in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("toxic").cast(pa.int64()), batch.column("held"), pa.array(found, pa.list_(pa.int32()))],
            ["id", "toxic", "held", "buckets"],
        )


def _only(shipped):
    """The buckets that are among the shipped ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.intersect1d(np.asarray(b, np.int32), shipped.value) for b in batch.column("buckets").to_pylist()
            ]
            columns_ = [*(batch.column(c) for c in ("id", "toxic", "held")), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns_, ["id", "toxic", "held", "buckets"])

    return run


def _learn(sample: DataFrame, hold: bool, most_features: int) -> tuple[Ordinal, np.ndarray, np.ndarray] | None:
    """The model of the sample, without the held-out part if ``hold``; scores less the lowest
    threshold and labels of that part. None without a toxic and a clean text to learn from."""
    taught = sample.where("not held") if hold else sample
    n, n_bad = taught.agg(F.count("*"), F.count_if(F.col("toxic") > 0)).first()
    if not 0 < n_bad < n:
        return None
    best = telling(taught, n, n_bad, most_features).select("bucket", "odds").toArrow()
    chosen, odds = (best.column(c).to_numpy() for c in ("bucket", "odds"))
    # Only the chosen features of the sampled texts come to the driver.
    shipped = sample.sparkSession.sparkContext.broadcast(np.sort(chosen))
    kept = sample.mapInArrow(_only(shipped), sample.schema)
    kept = kept.orderBy("id").toArrow()
    toxic = kept.column("toxic").to_numpy() > 0
    held = kept.column("held").to_numpy() & hold
    lists = kept.column("buckets").combine_chunks()
    rows = np.repeat(np.arange(len(toxic)), lists.value_lengths().to_numpy())
    cols = lists.flatten().to_numpy().astype(np.int64)
    strong = np.zeros(BUCKETS)
    strong[chosen[odds > 2]] = 1
    place, inside = np.cumsum(~held) - 1, ~held[rows]
    r, c = place[rows[inside]], cols[inside]
    model = fit(r, c, dose_grades(toxic[~held].astype(int), np.bincount(r, strong[c], n)), chosen, 4)
    weights = np.zeros(BUCKETS)
    weights[list(model.weights)] = list(model.weights.values())
    scores = np.bincount(rows, weights[cols], len(toxic)) - model.thresholds[0]
    return model, scores[held], toxic[held]


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    most_texts: tuple[int, int] = (10_000, 2_500),
    most_features: int = 32_768,
) -> Ordinal:
    """Fit on a bounded sample. Without a toxic and a clean text no text is toxic. Writes a table
    of the sample when called."""
    sample = _sample(docs, labels, id_col, text_col, toxic_col, most_texts)
    id_type = sample.schema["id"].dataType.simpleString()
    sample = sample.withColumn("held", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0)
    sample = stored(
        sample.mapInArrow(_buckets, f"id {id_type}, toxic long, held boolean, buckets array<int>"), "sample"
    )
    whole = _learn(sample, False, most_features)
    if whole is None:
        return Ordinal({}, np.array([20.0]))
    model = whole[0]
    part = _learn(sample, True, most_features)
    if part is not None:
        model.thresholds = model.thresholds + shift(*part[1:])
    return model


def _score(shipped, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Ordinal = shipped.value
        weights, cache = model.weights, {}

        def of(word: str) -> float:
            if len(cache) >= CACHED:
                cache.clear()
            cache[word] = value = sum(weights.get(b, 0.0) for b in features(word))
            return value

        for batch in batches:
            known = cache.get
            scores = []
            for text in field(batch, text_col).to_pylist():
                values = []
                for word in different_words(text):
                    value = known(word)
                    if value is None:
                        value = of(word)
                    if value:
                        values.append(value)
                scores.append(math.fsum(values))  # whatever the order of the words
            above = model.at_least(np.array(scores, float))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.StructArray.from_arrays(
                        [
                            pa.array(above.sum(axis=1)),
                            pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                            pa.array(above[:, 0].copy()),
                        ],
                        fields=list(OUT_ARROW),
                    ),
                ],
                ["row", "out"],
            )

    return run


def score(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """``row`` and ``out`` (severity, grade, p_toxic). Null and empty texts have no features and
    get the severity of the thresholds alone."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.struct("*").alias("row")).mapInArrow(
        _score(shipped, text_col), table_schema(docs, OUT)
    )
