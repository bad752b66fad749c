"""Spam classification: training, scoring and ensembles of logistic models.

Instances are ``(doc_id, label, features)`` with an array of integer features in which
repeats count; training sets add ``model_id``. Models are ``(model_id, feature, weight)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.plans.scratch import checkpointed, stored
from quern.plans.skew import hot_keys, sliced_join

# The learning rate and the two answers.
RATE = 0.002
SPAM, HAM = "spam", "ham"

def doc_features(texts: DataFrame, features: Column) -> DataFrame:
    """``(doc_id, feature)``, one row per occurrence."""
    return texts.select("doc_id", F.explode(features).alias("feature"))


def order_key(seed: Column | int, doc_id: str = "doc_id") -> Column:
    """A repeatable random key per instance and seed."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat_ws(":", seed.cast("string"), F.col(doc_id).cast("string")))


def shuffle_instances(instances: DataFrame, seed: int) -> DataFrame:
    """Instances in an order that depends on the seed only: a distributed sort by key."""
    return instances.withColumn("order_key", order_key(seed)).orderBy("order_key", "doc_id")


# So many documents of a training set are numbered at a time.
DOCUMENTS_AT_ONCE = 1000


def _online_pass(shard: pd.DataFrame, rate: float, model: pd.DataFrame | None = None) -> pd.DataFrame:
    """One pass of online logistic regression over documents in the given order, going on from
    ``model`` or from zero weights.

    Beside the documents themselves it holds the different features, numbers of some documents' features
    and the model."""
    documents, labels = shard["features"].to_list(), shard["label"].to_list()
    starts = range(0, len(documents), DOCUMENTS_AT_ONCE)
    known = np.zeros(0, "int32") if model is None else model["feature"].to_numpy()
    names = known
    for first in starts:
        names = np.union1d(names, np.concatenate(documents[first : first + DOCUMENTS_AT_ONCE]))
    weights = np.zeros(len(names))
    if model is not None:
        weights[np.searchsorted(names, known)] = model["weight"]
    for first in starts:
        some = documents[first : first + DOCUMENTS_AT_ONCE]
        found, places = np.unique(np.concatenate(some), return_inverse=True)
        places = np.searchsorted(names, found)[places]
        ends = np.cumsum([len(features) for features in some])
        for start, end, label in zip([0, *ends[:-1]], ends, labels[first:]):
            mine = places[start:end]
            score = weights[mine].sum()
            probability = 1.0 / (1.0 + np.exp(-score))
            np.add.at(weights, mine, (label - probability) * rate)
    return pd.DataFrame({"feature": names.astype("int32"), "weight": weights})


def _train_in_order(rate: float):
    """Models of documents that come model by model, each in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = model = None

        def fitted() -> pa.RecordBatch:
            ids = pa.array([current] * len(model), kind)
            weights = pa.Array.from_pandas(model["weight"])
            return pa.RecordBatch.from_arrays([ids, pa.array(model["feature"]), weights], ["model_id", "feature", "weight"])

        for batch in batches:
            ids, kind = batch.column("model_id").to_pylist(), batch.column("model_id").type
            ends = [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]
            for start, end in zip([0, *ends], [*ends, len(ids)]):
                if start == end:
                    continue
                if model is not None and ids[start] != current:
                    yield fitted()
                    model = None
                current = ids[start]
                shard = batch.slice(start, end - start).select(["label", "features"]).to_pandas()
                model = _online_pass(shard, rate, model)
        if model is not None:
            yield fitted()

    return run


def train_sgd(
    instances: DataFrame,
    rate: float = RATE,
    most_instances: int | None = None,
) -> DataFrame:
    """``(model_id, feature, weight)`` by one online pass per model, in order of ``order_key``.

    An online pass is a chain of dependent updates, which one task has to walk. Spark sorts the
    instances, on disk where they are many; the task reads them once, some at a time, and holds
    a weight per different feature. So every instance counts, however many a model has.
    With ``most_instances`` a caller may end the pass after so many instances of each model.
    """
    used = instances.where(F.size("features") > 0).select("model_id", "doc_id", "label", "features", "order_key")
    # Instances of the same key and id come in the order of their content, so that reruns agree.
    order = [F.col(c).asc_nulls_last() for c in ("order_key", "doc_id", "label", "features")]
    if most_instances is not None:
        first = Window.partitionBy("model_id").orderBy(*order)
        used = used.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most_instances)
    spark = instances.sparkSession
    # An explicit number: merging small partitions would put the chains of several models into one task.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = used.repartition(tasks, "model_id").sortWithinPartitions("model_id", *order)
    model_type = instances.schema["model_id"].dataType.simpleString()
    return ordered.select("model_id", "label", "features").mapInArrow(
        _train_in_order(rate), f"model_id {model_type}, feature int, weight double"
    )


def feature_counts(instances: DataFrame, *keys: str) -> DataFrame:
    """``(doc_id, keys, feature, times)``."""
    return (
        instances.select("doc_id", *keys, F.explode("features").alias("feature"))
        .groupBy("doc_id", *keys, "feature")
        .agg(F.count("*").alias("times"))
    )


def _hot_features(counts: DataFrame) -> DataFrame:
    spread = counts.groupBy("feature").agg(F.count("*").alias("documents"))
    return checkpointed(hot_keys(spread, "feature", "documents"))


def _scores(counts: DataFrame, weights: DataFrame, hot: DataFrame, per: list[str]) -> DataFrame:
    """Sum of times x weight per document (and model); features without weight count 0."""
    return (
        sliced_join(counts, weights, "feature", hot, ["doc_id"])
        .groupBy(*per)
        .agg(F.sum(F.col("times") * F.col("weight")).alias("score"))
    )


def train_batch(instances: DataFrame, steps: int, rate: float = RATE) -> DataFrame:
    """``(feature, weight)`` after full-batch gradient steps from zero weights.

    Each step is two joins and two sums, whatever the size of the training set: scores
    of documents by feature, then the error of each document back to its features. Not
    the numbers of the online pass, by design: all documents see the same weights.
    """
    counts = stored(feature_counts(instances), "features")
    hot = _hot_features(counts)
    labels = instances.select("doc_id", F.col("label").cast("double").alias("label"))
    weights = None
    for step in range(steps):
        if weights is None:
            scored = labels.withColumn("score", F.lit(0.0))
        else:
            scored = labels.join(_scores(counts, weights, hot, ["doc_id"]), "doc_id", "left")
        probability = 1 / (1 + F.exp(-F.coalesce("score", F.lit(0.0))))
        errors = scored.select("doc_id", ((F.col("label") - probability) * rate).alias("error"))
        moves = counts.join(errors, "doc_id").select(
            "feature", (F.col("times") * F.col("error")).alias("weight")
        )
        if weights is not None:
            moves = moves.unionByName(weights)
        weights = stored(
            moves.groupBy("feature").agg(F.sum("weight").alias("weight")), "weights"
        )
    return weights


def score_documents(instances: DataFrame, models: DataFrame) -> DataFrame:
    """``(doc_id, label, model_id, score, answer)`` for every document and stored model."""
    counts = stored(feature_counts(instances), "features")
    scores = _scores(counts, models, _hot_features(counts), ["doc_id", "model_id"])
    # Documents without any known feature still get a score of 0 from every model.
    model_ids = F.array_sort(F.collect_set("model_id"))
    all_models = models.select("model_id").distinct().agg(model_ids.alias("ids")).scalar()
    return (
        instances.select("doc_id", "label", F.explode(all_models).alias("model_id"))
        .join(scores, ["doc_id", "model_id"], "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("answer", answer(F.col("score")))
    )


def answer(score: Column) -> Column:
    return F.when(score > 0, SPAM).otherwise(HAM)


def ensemble_average(scored: DataFrame) -> DataFrame:
    """``(doc_id, label, score, answer)`` by the mean of the models' scores."""
    return _ensemble(scored, F.avg("score"))


def ensemble_vote(scored: DataFrame) -> DataFrame:
    """``(doc_id, label, score, answer)`` by votes: +1 for a positive score, else -1."""
    votes = F.sum(F.when(F.col("score") > 0, 1.0).otherwise(-1.0))
    return _ensemble(scored, votes)


def _ensemble(scored: DataFrame, combined: Column) -> DataFrame:
    return (
        scored.groupBy("doc_id", "label")
        .agg(combined.alias("score"))
        .withColumn("answer", answer(F.col("score")))
    )


def shuffle_trials(
    training: DataFrame,
    test: DataFrame,
    seeds: list[int],
    rate: float = RATE,
    most_instances: int | None = None,
    settle: Callable[[DataFrame], DataFrame] = lambda scored: scored,
) -> DataFrame:
    """``(model_id, one_minus_roca)``: one training and evaluation per seed, all at once.

    Each seed trains on all instances, unless ``most_instances`` is given, see ``train_sgd``.
    ``settle`` may round the scores, so that sums in another order tie alike.
    """
    from quern.operators.evaluate import one_minus_roca

    seeded = training.select(
        F.explode(F.array(*[F.lit(s) for s in seeds])).alias("model_id"),
        "doc_id",
        "label",
        "features",
    ).withColumn("order_key", order_key(F.col("model_id")))
    models = stored(train_sgd(seeded, rate, most_instances), "models")
    return one_minus_roca(settle(score_documents(test, models)))
