"""Hot keys: bounded, found, and without effect on results."""

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from quern.operators import bigrams, graph, index, pagerank
from quern.plans import scratch
from quern.plans.skew import hot_keys, sliced_join


def facts(spark):
    # A third of the rows has key 0.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )


def test_hot_keys(spark):
    counts = facts(spark).groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", "n", rows_per_slice=100, max_keys=50)
    assert [tuple(r) for r in hot.collect()] == [(0, 10)]
    # Below the average share no key counts as hot: the table stays under max_keys rows.
    even = spark.range(1000).select(F.col("id").alias("k"), F.lit(500).alias("n"))
    assert hot_keys(even, "k", "n", rows_per_slice=100, max_keys=50).count() == 0


def test_sliced_join_equals_join(spark):
    rows = facts(spark)
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k", "n", rows_per_slice=10, max_keys=1000)
    lookup = counts.where("k % 2 = 0")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sliced_join(rows, lookup, "k", hot, ["id"], how)
        expected = rows.join(lookup, "k", how)
        assert sorted(map(tuple, got.select(expected.columns).collect()), key=str) == sorted(
            map(tuple, expected.collect()), key=str
        )


def test_results_do_not_depend_on_slices(spark, monkeypatch):
    edges = spark.range(400).select((F.col("id") % 7).alias("src"), (F.col("id") * 3 % 11).alias("dst"))
    nodes = spark.range(10).select(F.col("id").alias("node_id"))

    def ranks(size):
        links = pagerank.prepare_links(nodes, edges, size)
        after = pagerank.ppr_iteration(links, pagerank.initial_ranks(nodes, [0, 3]))
        return {(r.source, r.node_id): round(r.rank, 12) for r in after.collect()}, links

    whole, links = ranks(1_000_000)
    cut, sliced = ranks(2)
    assert whole == cut
    assert links.hot.count() == 0 and sliced.hot.count() > 0
    sizes = sliced.rows.groupBy("src", "slice").count().agg(F.max("count")).first()[0]
    assert sizes < links.rows.groupBy("src").count().agg(F.max("count")).first()[0]


def test_graph_nodes_in_slices(spark):
    edges = spark.range(100).select(F.lit(1).cast("bigint").alias("src"), F.col("id").alias("dst"))
    nodes = spark.range(3).select(F.col("id").alias("node_id"))
    records = graph.graph_nodes(nodes, edges, [1], neighbours_per_row=30)
    mine = records.where("node_id = 1").collect()
    assert len(mine) > 1 and sorted(d for r in mine for d in r.neighbours) == list(range(100))
    assert {r.out_degree for r in mine} == {100}


def test_frequent_words_in_slices(spark, monkeypatch):
    lines = spark.createDataFrame(
        [(i, f"the w{chr(97 + i % 26)} the x") for i in range(200)], "line_id bigint, line string"
    )

    def run():
        pairs = bigrams.bigram_relfreq_pairs(lines)
        terms = index.flat(index.inverted_index(lines, block=10))
        return sorted(map(tuple, pairs.collect())), sorted(map(tuple, terms.collect()))

    whole = run()
    small = lambda counts, key, weight, *_: hot_keys(counts, key, weight, 5, 1000)
    monkeypatch.setattr(bigrams, "hot_keys", small)
    monkeypatch.setattr(index, "hot_keys", small)
    assert run() == whole


def test_temporary_tables_go_and_no_others(spark):
    def there(rows):
        return Path(urlparse(rows.inputFiles()[0]).path).exists()

    kept = scratch.stored(spark.range(5))
    with scratch.temporary(spark) as outer:
        first = scratch.stored(spark.range(5))
        with scratch.temporary(spark) as made:
            gone, stays = scratch.stored(spark.range(3)), scratch.stored(spark.range(4))
            made.pop()
        assert not there(gone) and there(stays) and there(first) and len(outer) == 1
    assert there(kept) and there(stays) and not there(first)
    with pytest.raises(ValueError, match="inside"), scratch.temporary(spark):
        lost = scratch.stored(spark.range(2))
        raise ValueError("inside")
    assert not there(lost) and stays.count() == 4
