"""Plans have the shape they are meant to have at scale."""

import pytest
from pyspark.sql import functions as F

from quern.plans import scratch
from quern.plans.inputs import spread, table
from quern.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
# Registered queries whose own work ends in a lazy plan that can be looked at.
LAZY = [
    "pricing_summary", "nation_shipments", "nation_monthly_shipments", "orders_by_shipdate",
    "part_supplier_by_shipdate", "unshipped_revenue_topk", "word_count", "cooccurrence_window",
    "pmi_pairs", "pmi_forward", "inverted_index", "boolean_retrieval", "fetch_snippets",
    "bigram_relfreq_pairs", "score_documents", "one_minus_roca", "window_state_history",
    "graph_nodes", "region_event_count",
]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_small_tables(spark):
    """Plan as if no table were small enough to be broadcast by its size."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products(spark, no_small_tables, name):
    text = plan(all_queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_filter_reaches_the_scan(spark):
    frame = all_queries()["shipdate_count"](spark, FOLDER)
    text = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(l_shipdate,1996-01-02T00:00)" in text
    assert "LessThan(l_shipdate,1996-01-03T00:00)" in text
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in text


def test_sum_and_join_share_a_shuffle(spark, no_small_tables):
    text = plan(all_queries()["unshipped_revenue_topk"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 2
    assert "TakeOrderedAndProject" in text
    # The customer table is neither shuffled nor sorted: the chosen orders are broadcast.
    assert "BuildLeft" in text


def test_monthly_lines_are_shuffled_once(spark, no_small_tables):
    text = plan(all_queries()["nation_monthly_shipments"](spark, FOLDER))
    assert text.count("hashpartitioning(l_orderkey") == 1


def test_only_small_inputs_are_dealt_out(spark, tmp_path):
    small = table(spark, FOLDER, "documents")
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    path = str(tmp_path / "many")
    spark.range(100).repartition(20).write.parquet(path)
    many = spark.read.parquet(path)
    assert spread(many) is many


def test_a_task_gets_one_part_of_the_files_at_most(spark, tmp_path, monkeypatch):
    from quern.plans import inputs

    spark.range(1000).repartition(1).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(inputs, "PART_BYTES", 100)
    dealt = inputs.spread(rows)
    assert dealt.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i)) for i in range(files.size())}

    before = shuffled()
    counts = scratch.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert counts.count() == 7 and spark.conf.get(scratch.CLEANUP, None) in (None, "false")
    left = {f for f in shuffled() - before if f.endswith(".data")}
    assert len(left) <= 1  # that of the count just made
