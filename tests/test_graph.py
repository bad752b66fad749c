"""Graph checks and personalized PageRank against a plain loop."""

import pytest
from pyspark.sql import functions as F

from quern.operators import graph, pagerank, records
from quern.plans.scratch import stored
from quern.sources.graphs import adjacency_edges, adjacency_nodes, scan_adjacency

# 1 -> 2 -> 3 -> 1 with a repeated edge, 4 dangling, 9 without record.
ADJACENCY = ["1 2 2 4", "2 3", "3  1\t9", "4", ""]


@pytest.fixture(scope="module")
def tiny(spark):
    adjacency = scan_adjacency(spark.createDataFrame([(x,) for x in ADJACENCY], "value string"))
    return adjacency_nodes(adjacency), adjacency_edges(adjacency)


def plain(sources, steps):
    out = {1: [2, 2, 4], 2: [3], 3: [1, 9], 4: []}
    ranks = {s: {s: 1.0} for s in sources}
    for _ in range(steps):
        for s in sources:
            mass = dict.fromkeys(out, 0.0)
            for u, r in ranks[s].items():
                for v in out[u]:
                    if v in out:
                        mass[v] += r / len(out[u])
            missing = max(0.0, 1 - sum(mass.values()))
            ranks[s] = {v: 0.85 * m for v, m in mass.items()}
            ranks[s][s] += 0.15 + 0.85 * missing
    return {(s, v): r for s in sources for v, r in ranks[s].items() if r > 0}


def found(frame):
    return {(r.source, r.node_id): r.rank for r in frame.collect()}


def test_adjacency(tiny):
    nodes, edges = tiny
    assert sorted(r.node_id for r in nodes.collect()) == [1, 2, 3, 4]
    assert sorted(map(tuple, edges.collect())) == [(1, 2), (1, 2), (1, 4), (2, 3), (3, 1), (3, 9)]


def test_checks(tiny):
    nodes, edges = tiny
    assert tuple(graph.graph_stats(nodes, edges).first()) == (4, 6, 3)
    assert [tuple(r)[:2] for r in graph.graph_missing_structure(nodes, edges).collect()] == [(9, 1)]
    twice = graph.graph_duplicate_nodes(nodes.unionAll(nodes.where("node_id = 2")))
    assert [tuple(r) for r in twice.collect()] == [(2, 2)]
    with pytest.raises(ValueError):
        pagerank.prepare_links(nodes.unionAll(nodes), edges)


def test_records(tiny):
    rows = {r.node_id: r for r in graph.graph_nodes(*tiny, [1, 4]).collect()}
    assert rows[1].neighbours == [2, 2, 4] and rows[1].out_degree == 3
    assert rows[4].neighbours == [] and rows[4].out_degree == 0
    assert rows[4].ranks == [0.0, 1.0]


def test_partition(spark):
    nodes = spark.range(100).withColumnRenamed("id", "node_id")
    edges = nodes.select(F.col("node_id").alias("src"), (F.col("node_id") + 1).alias("dst")).where("src % 4 = 0")
    whole = graph.graph_nodes(nodes, edges, [3])
    for by in ("id", "range"):
        laid = graph.graph_partition(whole, 7, by)
        assert laid.rdd.getNumPartitions() == 7 and laid.columns == whole.columns
        assert sorted(r.node_id for r in laid.collect()) == list(range(100))
        report = {r.part: (r.num_nodes, r.num_edges) for r in graph.partition_report(laid).collect()}
        if by == "id":
            assert report == {p: (len(range(p, 100, 7)), sum(i % 4 == 0 for i in range(p, 100, 7))) for p in range(7)}
        parts = laid.select(F.spark_partition_id().alias("p"), "node_id").groupBy("p").agg(F.max("node_id"), F.min("node_id"))
        if by == "range":
            ends = sorted(map(tuple, parts.collect()))
            assert all(x[1] < y[2] for x, y in zip(ends, ends[1:], strict=False))


@pytest.mark.parametrize(("steps", "per_row"), [(1, 2_000_000), (5, 2_000_000), (3, 1)])
def test_pagerank_on_stored_records(tiny, steps, per_row):
    whole = graph.graph_nodes(*tiny, [1, 4], neighbours_per_row=per_row)
    laid = records.iterate(records.store_records(whole, [1, 4]), steps)
    got, expected = found(records.flat_ranks(laid)), plain([1, 4], steps)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in expected)
    assert len(laid.counters) == steps
    last = laid.counters[-1]
    assert abs(last["mass_1"] + last["lost_1"] - 1) < 1e-12 and last["nodes"] >= 1


def test_a_step_on_records_moves_one_thing(spark, tiny):
    def exchanges(rows):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid = records.store_records(graph.graph_nodes(*tiny, [1, 4]), [1, 4])
        links = pagerank.prepare_links(*tiny)
        on_records, on_links = records.records_step(laid), pagerank.ppr_step(links, pagerank.initial_ranks(tiny[0], [1, 4]))
        assert exchanges(on_records) == 1 < exchanges(on_links)
        links.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counters_of_iterations(tiny):
    counters = []
    ranks = pagerank.personalized_pagerank(*tiny, [1, 4], 3, counters=counters)
    assert [c["iteration"] for c in counters] == [1, 2, 3]
    assert counters[-1]["rows"] == ranks.count() and abs(counters[-1]["rank"] - 2) < 1e-12


@pytest.mark.parametrize("steps", [1, 2, 5])
def test_pagerank(tiny, steps):
    got = found(pagerank.personalized_pagerank(*tiny, [1, 4], steps))
    expected = plain([1, 4], steps)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in expected)
    for source in (1, 4):
        assert abs(sum(r for (s, _), r in got.items() if s == source) - 1) < 1e-12


def test_resume(tiny, tmp_path):
    state = str(tmp_path / "state")
    pagerank.personalized_pagerank(*tiny, [1, 4], 2, state=state)
    resumed = found(pagerank.personalized_pagerank(*tiny, [1, 4], 5, state=state, start=2))
    assert resumed == pytest.approx(plain([1, 4], 5))


def test_step_and_missing_mass(tiny):
    links = pagerank.prepare_links(*tiny)
    ranks = pagerank.initial_ranks(tiny[0], [3, 4])
    step = {(r.source, r.node_id): r.mass for r in pagerank.ppr_step(links, ranks).collect()}
    assert step == {(3, 1): 0.5}
    lost = {r.source: r.missing for r in pagerank.ppr_missing_mass(links, ranks).collect()}
    assert lost == {3: 0.5, 4: 1.0}


def test_topk(spark):
    ranks = spark.createDataFrame(
        [(1, n, 0.25 * (n % 3) + 0.25) for n in range(9)] + [(2, 5, 1.0)],
        "source bigint, node_id bigint, rank double",
    )
    top = pagerank.ppr_topk(ranks, 4)
    assert sorted(map(tuple, top.collect())) == [
        (1, 1, 2, 0.75), (1, 2, 5, 0.75), (1, 3, 8, 0.75), (1, 4, 1, 0.5), (2, 1, 5, 1.0),
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_links_stay_in_place(tiny):
    links = pagerank.prepare_links(*tiny)
    spark = links.rows.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = links.of(stored(pagerank.initial_ranks(tiny[0], [1])))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "InMemoryTableScan" in plan
        # One exchange and one sort: those of the rank rows.
        above = plan.split("InMemoryTableScan")[0]
        assert above.count("Exchange hashpartitioning") == 1 and above.count("Sort [") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        links.release()


def test_partitions_of_large_graphs_follow_the_size_of_the_tables(spark, tmp_path, monkeypatch):
    """Peak memory of a task grew with the tables: the number of partitions did not."""
    from quern.plans import inputs
    from quern.sources import files

    rows = spark.range(60_000).selectExpr("id % 9000 AS l_orderkey", "id % 7001 AS l_partkey", "id % 101 AS l_suppkey")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(9000).selectExpr("id AS o_orderkey", "id % 977 AS o_custkey").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = inputs.trade_edges(spark, str(tmp_path))
    assert files.shuffle_parts(found) == least
    assert files.shuffle_parts(found, part_bytes=1000) > 10 * least
    many = 3 * least
    monkeypatch.setattr(inputs, "shuffle_parts", lambda rows: many)
    monkeypatch.setattr(graph, "shuffle_parts", lambda rows: many)
    again = inputs.trade_edges(spark, str(tmp_path))
    assert len(again.inputFiles()) > 2 * least
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
    nodes = again.selectExpr("src AS node_id").union(again.selectExpr("dst")).distinct().where("node_id % 5 > 0")
    links = graph.weighted_links(nodes, again)
    total = links.groupBy("src").sum("weight").agg({"sum(weight)": "min"}).first()[0]
    assert abs(total - 1) < 1e-9


def test_a_resumed_run_uses_the_links_of_the_first(tiny, tmp_path, monkeypatch):
    made, real = [], pagerank.weighted_links
    monkeypatch.setattr(pagerank, "weighted_links", lambda *graph: made.append(1) or real(*graph))
    state = str(tmp_path / "state")
    pagerank.personalized_pagerank(*tiny, [1, 4], 1, state=state)
    resumed = found(pagerank.personalized_pagerank(*tiny, [1, 4], 5, state=state, start=1))
    assert resumed == pytest.approx(plain([1, 4], 5)) and len(made) == 1
    (tmp_path / "state" / "links" / "_SUCCESS").unlink()  # as if the first run had been lost while it wrote
    resumed = found(pagerank.personalized_pagerank(*tiny, [1, 4], 5, state=state, start=1))
    assert resumed == pytest.approx(plain([1, 4], 5)) and len(made) == 2
