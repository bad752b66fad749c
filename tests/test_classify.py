"""Training, scoring, ensembles and ROC against plain loops."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import classify, evaluate
from quern.sources import sinks
from quern.sources.instances import scan_labelled_features

# doc_id, label, features with repeats, order
DOCUMENTS = [
    (1, 1, [7, 7, 9], "b"), (2, 0, [9, 4], "a"), (3, 1, [4, 4, 4, 7], "e"), (4, 0, [5], "d"),
    (5, 0, [], "c"),
]
SCHEMA = "doc_id bigint, label int, features array<int>, order_key string"


def plain_online(documents, rate=0.002):
    w = {}
    for _, label, features, _ in sorted(documents, key=lambda d: (d[3], d[0])):
        p = 1 / (1 + math.exp(-sum(w.get(f, 0.0) for f in features)))
        for f in features:
            w[f] = w.get(f, 0.0) + (label - p) * rate
    return w


def weights(frame, model_id=0):
    return {r.feature: r.weight for r in frame.collect() if r.model_id == model_id}


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(DOCUMENTS, SCHEMA).withColumn("model_id", F.lit(0))


def test_parse(spark):
    lines = spark.createDataFrame([("d1 spam 3 5 3",), ("d2 ham",)], "value string")
    assert [tuple(r) for r in scan_labelled_features(lines).collect()] == [
        ("d1", 1, [3, 5, 3]), ("d2", 0, []),
    ]


@pytest.mark.parametrize("rate", [0.002, 0.7])
def test_online_training(training, rate):
    assert weights(classify.train_sgd(training, rate)) == pytest.approx(
        plain_online(DOCUMENTS, rate), abs=1e-12
    )


def test_models_train_side_by_side(spark, training):
    other = training.withColumn("label", 1 - F.col("label")).withColumn("model_id", F.lit(1))
    models = classify.train_sgd(training.unionByName(other))
    flipped = [(d, 1 - y, f, o) for d, y, f, o in DOCUMENTS]
    assert weights(models) == pytest.approx(plain_online(DOCUMENTS), abs=1e-12)
    assert weights(models, 1) == pytest.approx(plain_online(flipped), abs=1e-12)


def test_training_uses_the_first_instances_of_a_model(spark):
    rng = random.Random(5)
    docs = [
        (i, rng.randint(0, 1), [rng.randint(0, 20) for _ in range(5)], f"{rng.random():.9f}")
        for i in range(200)
    ]
    rows = spark.createDataFrame(docs, SCHEMA).withColumn("model_id", F.lit(0))
    got = weights(classify.train_sgd(rows, 0.5, most_instances=50))
    first = sorted(docs, key=lambda d: d[3])[:50]
    assert got == pytest.approx(plain_online(first, 0.5), abs=1e-12)


def test_batch_training(training):
    w = {}
    for _ in range(3):
        move = {}
        for _, label, features, _ in DOCUMENTS:
            p = 1 / (1 + math.exp(-sum(w.get(f, 0.0) for f in features)))
            for f in features:
                move[f] = move.get(f, 0.0) + (label - p) * 0.1
        w = {f: w.get(f, 0.0) + m for f, m in move.items()}
    got = {r.feature: r.weight for r in classify.train_batch(training, 3, 0.1).collect()}
    assert got == pytest.approx(w, abs=1e-12)


MODELS = [(0, 7, 1.0), (0, 9, -3.0), (1, 4, 0.5), (2, 7, -1.0), (2, 5, 2.0)]


@pytest.fixture(scope="module")
def models(spark):
    return spark.createDataFrame(MODELS, "model_id int, feature int, weight double")


def test_scores_and_ensembles(training, models):
    scored = classify.score_documents(training.drop("model_id"), models)
    found = {(r.doc_id, r.model_id): r.score for r in scored.collect()}
    for doc, _, features, _ in DOCUMENTS:
        for m in range(3):
            w = {f: x for i, f, x in MODELS if i == m}
            assert found[doc, m] == pytest.approx(sum(w.get(f, 0.0) for f in features))
    assert all((r.score > 0) == (r.answer == "spam") for r in scored.collect())
    mean = {r.doc_id: r.score for r in classify.ensemble_average(scored).collect()}
    vote = {r.doc_id: r.score for r in classify.ensemble_vote(scored).collect()}
    for doc, *_ in DOCUMENTS:
        mine = [found[doc, m] for m in range(3)]
        assert mean[doc] == pytest.approx(sum(mine) / 3)
        assert vote[doc] == sum(1 if s > 0 else -1 for s in mine)


def test_model_store(spark, models, tmp_path):
    path = str(tmp_path / "models")
    sinks.write_models(models, path)
    sinks.write_models(models, path)
    stored = sinks.read_models(spark, path).select("model_id", "feature", "weight")
    assert sorted(map(tuple, stored.collect())) == sorted(MODELS)
    assert sinks.read_models(spark, path, [2]).count() == 2


def test_members_of_an_ensemble_prune_the_store_at_run_time(spark, training, tmp_path):
    path = str(tmp_path / "models")
    models = spark.createDataFrame(MODELS, "model_id int, feature int, weight double")
    sinks.write_models(models, path)
    spark.createDataFrame([(1, 0.2), (2, 0.9)], "model_id int, area double").write.parquet(str(tmp_path / "areas"))
    members = spark.read.parquet(str(tmp_path / "areas")).where("area < 0.5")
    chosen = sinks.read_ensemble(spark, path, members)
    assert "dynamicpruning" in chosen._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, chosen.select("model_id", "feature", "weight").collect()))
    assert got == sorted(m for m in MODELS if m[0] == 1) and got


@pytest.mark.parametrize("points_per_part", [1, 3, 11, 1000])
def test_area_with_ties(spark, points_per_part):
    rng = random.Random(11)
    rows = [(g, rng.randint(0, 1), float(rng.randint(-9, 9))) for g in (1, 2) for _ in range(120)]
    # A third of one group has the same score.
    rows += [(1, i % 2, 0.0) for i in range(60)]
    scored = spark.createDataFrame(rows, "model_id int, label int, score double")
    got = {r.model_id: r.one_minus_roca for r in evaluate.one_minus_roca(scored, points_per_part=points_per_part).collect()}
    for g in (1, 2):
        spam = [s for m, y, s in rows if m == g and y == 1]
        ham = [s for m, y, s in rows if m == g and y == 0]
        won = sum((a > b) + (a == b) / 2 for a in spam for b in ham)
        assert got[g] == pytest.approx((1 - won / (len(spam) * len(ham))) * 100)


def test_area_in_parts_that_do_not_grow(spark):
    for n in (2_000, 20_000):
        points = spark.range(n).selectExpr("id % 3 AS model_id", "id / 7 AS score", "1L AS spam", "id % 5 AS ham")
        below = evaluate.ham_below(points, points_per_part=500)
        largest, parts = below.groupBy("part").count().agg(F.max("count"), F.count("*")).first()
        assert largest < 1500 and n / 1500 < parts <= n / 500
        got = {(r.model_id, r.score): r.ham_below for r in below.collect()}
        run = [0, 0, 0]
        for i in range(n):
            assert got[i % 3, i / 7] == run[i % 3]
            run[i % 3] += i % 5


def test_area_without_spam_and_with_nulls(spark):
    rows = [(1, 0, 0.5), (1, 0, 0.1), (None, 1, 0.2), (None, 0, None), (None, 0, 0.9)]
    scored = spark.createDataFrame(rows, "model_id int, label int, score double")
    assert {r.model_id: r.one_minus_roca for r in evaluate.one_minus_roca(scored).collect()} == {1: None, None: 50.0}
    assert evaluate.one_minus_roca(scored.where("false")).count() == 0


def test_shuffle_is_repeatable(training):
    def order(seed):
        return [r.doc_id for r in classify.shuffle_instances(training, seed).collect()]

    assert order(1) == order(1) and sorted(order(1)) == sorted(order(2))
    assert len({tuple(order(s)) for s in range(6)}) > 1


def test_trials(training):
    trials = classify.shuffle_trials(training.drop("model_id", "order_key"), training, [1, 2, 3], 0.5)
    assert {r.model_id for r in trials.collect()} == {1, 2, 3}


def test_parse_a_document_without_features(spark):
    """What is written for a document without words ends in a blank."""
    lines = spark.createDataFrame([("5 ham ",), ("6 spam",), ("7 ham 3 ",)], "value string")
    assert [tuple(r) for r in scan_labelled_features(lines).collect()] == [
        ("5", 0, []), ("6", 1, []), ("7", 0, [3]),
    ]


def test_an_online_pass_holds_little_beside_its_documents():
    """Numbers of features are made for some documents at a time, with the same weights."""
    rng = np.random.default_rng(3)
    features = [rng.integers(0, 5000, 200, dtype="int32") for _ in range(6000)]
    documents = [(i, i % 2, f, f"{i:05d}") for i, f in enumerate(features)]
    shard = pd.DataFrame(documents, columns=["doc_id", "label", "features", "order_key"])
    tracemalloc.start()
    found = classify._online_pass(shard, 0.002)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    plain = [(i, label, f.tolist(), key) for i, label, f, key in documents]
    assert dict(zip(found["feature"], found["weight"])) == pytest.approx(plain_online_repeats(plain), abs=1e-9)
    assert most < 3 * sum(f.nbytes for f in features)


def plain_online_repeats(documents, rate=0.002):
    w = Counter()
    for _, label, features, _ in documents:
        p = 1 / (1 + math.exp(-sum(w[f] for f in features)))
        for f in features:
            w[f] += (label - p) * rate
    return w


def test_an_online_pass_over_many_instances_uses_all(spark):
    """More instances than any former limit, of three models (one without id), in batches that end anywhere."""
    rng = random.Random(9)
    docs = [(i, rng.randint(0, 1), [rng.randint(0, 9), 10 + i // 1000], f"{rng.random():.12f}", m)
            for m, n in ((0, 60_000), (1, 300), (None, 50)) for i in range(n)]
    rows = spark.createDataFrame(docs, SCHEMA + ", model_id int")
    models = classify.train_sgd(rows, 0.05).collect()
    for m in (0, 1, None):
        got = {r.feature: r.weight for r in models if r.model_id == m}
        assert got == pytest.approx(plain_online([d[:4] for d in docs if d[4] == m], 0.05), abs=1e-9)


def test_every_trial_trains_on_all_instances(spark):
    rng = random.Random(4)
    docs = [(i, rng.randint(0, 1), [rng.randint(0, 9), 10 + i // 1000]) for i in range(55_000)]
    rows = spark.createDataFrame(docs, "doc_id bigint, label int, features array<int>")
    test, scored = rows.where("doc_id % 500 = 0"), []
    classify.shuffle_trials(rows, test, [3], 0.05, settle=lambda s: scored.append(s) or s)
    ordered = [(*d, hashlib.md5(f"3:{d[0]}".encode()).hexdigest()) for d in docs]
    w = plain_online(ordered, 0.05)
    got = {r.doc_id: r.score for r in scored[0].collect()}
    assert got == pytest.approx({i: sum(w[f] for f in features) for i, _, features in docs if i % 500 == 0}, abs=1e-9)
