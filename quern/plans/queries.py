"""Every operator bound to the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import regions
from quern.functions.features import hashed_feature
from quern.functions.tokens import tokens
from quern.operators import (
    bigrams,
    classify,
    cooccur,
    counts,
    evaluate,
    graph,
    index,
    pagerank,
    records,
    reports,
    retrieval,
    windows,
)
from quern.operators import region_join as region_joins
from quern.plans.inputs import (
    BOXES,
    cyclic_edges,
    day,
    event_point,
    formula_models,
    instances,
    part_boxes,
    table,
    text_lines,
    trade_edges,
    trade_nodes,
)
from quern.plans.scratch import fresh_path, stored
from quern.sources import graphs, sinks, tables
from quern.sources import index_store as indexes
from quern.sources import instances as labelled
from quern.sources.lines import LINES_PER_DOCUMENT
from quern.streaming import replay
from quern.streaming import windows as streams

Query = Callable[[SparkSession, str], DataFrame]

DATE = "1996-01-02"
MONTH = "1996-01"
NATIONS = ("NATION_2", "NATION_3")
SOURCES = (0, 3, 6)  # customers 0, 1 and 2
ITERATIONS = 3
TERMS = ("the", "der", "que", "zzyzx")
BOOLEAN_QUERIES = {
    "q1": "the of AND",
    "q2": "der und AND la OR",
    "q3": "the is that OR AND with this OR AND",
    "q4": "zzyzx the AND",
    "q5": "zzyzx que OR",
    "q6": "was",
}
DELAY = "1 hour"
HOUR = "1 hour"
HOURLY = timedelta(hours=1)
DAY = "1 day"
MIN_EVENTS = 5

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _moment(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _line_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumn("l_shipdate", day("l_shipdate"))


# Sources and sinks


@query
def scan_delimited(spark, sf):
    path = fresh_path(spark, "delimited")
    rows = _line_columns(table(spark, sf, "lineitem"))
    fields = rows.withColumn("end", F.lit(""))
    fields.write.option("sep", "|").option("emptyValue", "").csv(f"{path}/lineitem.tbl")
    return tables.scan_delimited(spark, path, "lineitem", rows.schema)


@query
def scan_parquet(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", day("o_orderdate"))


@query
def scan_lines(spark, sf):
    return text_lines(spark, sf)


@query
def scan_adjacency(spark, sf):
    path = fresh_path(spark, "adjacency")
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(" ", "l_orderkey", "l_partkey", "l_suppkey").alias("value")
    )
    lone = table(spark, sf, "customer").select(F.col("c_custkey").cast("string"))
    lines.unionAll(lone).write.text(path)
    adjacency = graphs.scan_adjacency(spark.read.text(path))
    return adjacency.select(
        "node_id",
        F.size("neighbours").alias("out_degree"),
        F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"),
    )


@query
def scan_labelled_features(spark, sf):
    path = fresh_path(spark, "labelled")
    instances(spark, sf).select(
        F.concat_ws(
            " ",
            F.col("doc_id").cast("string"),
            F.when(F.col("label") == 1, labelled.SPAM).otherwise("ham"),
            F.array_join(F.col("features").cast("array<string>"), " "),
        )
    ).write.text(path)
    parsed = labelled.scan_labelled_features(spark.read.text(path))
    return parsed.select(
        "doc_id",
        "label",
        F.size("features").alias("num_features"),
        F.array_join(F.col("features").cast("array<string>"), ",").alias("features"),
    )


@query
def stream_files(spark, sf):
    path = fresh_path(spark, "replay")
    events = table(spark, sf, "events")
    replay.land_slices(events, f"{path}/in", "ts", 4)
    stream = replay.stream_files(spark, f"{path}/in", events.schema)
    return streams.drained(spark, stream, path).select(
        "event_id", _moment("ts"), "user_id", "event_type", "value"
    )


@query
def write_text_table(spark, sf):
    path = fresh_path(spark, "text")
    customer = table(spark, sf, "customer")
    sinks.write_text_table(customer, path)
    return sinks.read_text_table(spark, path, customer.schema)


@query
def model_store(spark, sf):
    path = fresh_path(spark, "models")
    sinks.write_models(formula_models(instances(spark, sf), 3), path)
    return sinks.read_models(spark, path, [1, 3]).select(
        F.col("model_id").cast("int").alias("model_id"),
        "feature",
        F.round("weight", 6).alias("weight"),
    )


@query
def index_store(spark, sf):
    path = fresh_path(spark, "index")
    indexes.write_index(index.posting_blocks(text_lines(spark, sf)), path)
    found = indexes.read_index(spark, path)
    return found.dictionary.drop("slices").join(
        found.blocks.groupBy("term").agg(
            F.sum(F.size("postings")).alias("stored"),
            F.min(F.element_at("postings", 1)["line_id"]).alias("first_id"),
            F.max(F.element_at("postings", -1)["line_id"]).alias("last_id"),
        ),
        "term",
    )


def _slices(spark, sf, path, length=windows.COUNT_WINDOW, slices=3):
    """The events as a stream that grows by a period at a time, then by the event that closes
    it. All files of a period are one micro-batch, so none can overtake another."""
    events = table(spark, sf, "events")
    closing = replay.closing_event(events, "ts", length, DELAY)
    parts = replay.time_slices(events, "ts", slices)
    for part in [*parts, closing] if slices > 1 else [parts[0].unionByName(closing)]:
        replay.land(part, f"{path}/in", "ts")
        yield replay.stream_files(spark, f"{path}/in", events.schema, files_per_batch=None)


def _replayed(spark, sf, label, make, slices=1):
    """What a stream, stopped and started again after each period, has written in the end."""
    path = fresh_path(spark, label)
    for stream in _slices(spark, sf, path, slices=slices):
        found = streams.drained(spark, make(stream), path)
    return found


@query
def stream_sink_windows(spark, sf):
    path = fresh_path(spark, "windows")
    for stream in _slices(spark, sf, path):
        closed = streams.stream_window_count(stream, "ts", windows.COUNT_WINDOW, DELAY)
        streams.drain(spark, streams.write_windows(closed, f"{path}/out", f"{path}/checkpoint"))
    stored = spark.read.schema("n bigint, window_ms bigint, batch bigint").parquet(f"{path}/out")
    return stored.select("window_ms", "n")


# Filters, projections, scalar functions


@query
def shipdate_filter(spark, sf):
    return _line_columns(reports.shipdate_filter(table(spark, sf, "lineitem"), MONTH))


@query
def shipdate_filter_fragment(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return reports.shipdate_filter(lineitem, "6-01-0").groupBy(
        day("l_shipdate").alias("shipdate")
    ).agg(F.count("*").alias("n"))


@query
def date_before_after(spark, sf):
    return reports.ordered_before_shipped_after(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), DATE
    )


@query
def date_before_after_month(spark, sf):
    return reports.ordered_before_shipped_after(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), MONTH
    )


@query
def month_bucket(spark, sf):
    return reports.monthly_lines(table(spark, sf, "lineitem"))


@query
def tokenize_lines(spark, sf):
    return counts.tokenize_lines(text_lines(spark, sf))


@query
def first_k_distinct_tokens(spark, sf):
    return counts.first_k_distinct_tokens(text_lines(spark, sf))


def _located(events: DataFrame) -> DataFrame:
    return regions.region_assign(events, *event_point(), BOXES)


@query
def region_assign(spark, sf):
    return _located(table(spark, sf, "events")).select("event_id", "event_type", "region")


@query
def region_join(spark, sf):
    found = region_joins.region_join(table(spark, sf, "events"), *event_point(), part_boxes(spark, sf))
    return found.select("event_id", "event_type", "region")


# Joins and reports


@query
def orders_by_shipdate(spark, sf):
    return reports.orders_by_shipdate(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), DATE, clerk="o_orderpriority"
    )


@query
def orders_by_shipdate_semi(spark, sf):
    return reports.orders_by_shipdate_semi(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), DATE, clerk="o_orderpriority"
    )


@query
def part_supplier_by_shipdate(spark, sf):
    return reports.part_supplier_by_shipdate(
        *(table(spark, sf, name) for name in ("lineitem", "part", "supplier")), DATE
    )


@query
def graph_missing_structure(spark, sf):
    return graph.graph_missing_structure(
        trade_nodes(spark, sf, small_parts=False), trade_edges(spark, sf)
    )


@query
def shipdate_count(spark, sf):
    return reports.shipdate_count(table(spark, sf, "lineitem"), DATE)


@query
def nation_shipments(spark, sf):
    names = ("lineitem", "orders", "customer", "nation")
    return reports.nation_shipments(*(table(spark, sf, name) for name in names), DATE)


@query
def nation_monthly_shipments(spark, sf):
    names = ("lineitem", "orders", "customer", "nation")
    return reports.nation_monthly_shipments(*(table(spark, sf, name) for name in names), NATIONS)


@query
def pricing_summary(spark, sf):
    return reports.pricing_summary(table(spark, sf, "lineitem"), DATE)


@query
def unshipped_revenue_topk(spark, sf):
    names = ("lineitem", "orders", "customer")
    return reports.unshipped_revenue_topk(
        *(table(spark, sf, name) for name in names), DATE, priority="o_orderpriority"
    )


@query
def word_count(spark, sf):
    return counts.word_count(text_lines(spark, sf))


@query
def word_count_min(spark, sf):
    return counts.word_count(text_lines(spark, sf), min_count=2)


@query
def line_doc_frequency(spark, sf):
    return counts.line_doc_frequency(text_lines(spark, sf))


@query
def line_count(spark, sf):
    return counts.line_count(text_lines(spark, sf))


@query
def top_terms(spark, sf):
    return counts.top_terms(text_lines(spark, sf))


# Bigrams, co-occurrence, PMI


@query
def bigram_count(spark, sf):
    return bigrams.bigram_count(text_lines(spark, sf))


@query
def bigram_relfreq_pairs(spark, sf):
    return _rounded(bigrams.bigram_relfreq_pairs(text_lines(spark, sf)), "frequency")


@query
def bigram_relfreq_stripes(spark, sf):
    maps = bigrams.bigram_relfreq_stripes(text_lines(spark, sf))
    rows = maps.select("left_word", F.explode("stripe").alias("right_word", "frequency"))
    return _rounded(rows, "frequency")


@query
def cooccurrence_window(spark, sf):
    return cooccur.cooccurrence_window(text_lines(spark, sf))


@query
def pmi_pairs(spark, sf):
    return _rounded(cooccur.pmi_pairs(text_lines(spark, sf)), "pmi")


@query
def pmi_stripes(spark, sf):
    maps = cooccur.pmi_stripes(text_lines(spark, sf))
    rows = maps.select("left_word", F.explode("stripe").alias("right_word", "entry"))
    return _rounded(rows.select("left_word", "right_word", "entry.pmi", "entry.n"), "pmi")


@query
def pmi_occurrence(spark, sf):
    return _stripe_texts(cooccur.pmi_occurrence(text_lines(spark, sf)))


@query
def pmi_forward(spark, sf):
    return _stripe_texts(cooccur.pmi_forward(text_lines(spark, sf)))


def _stripe_texts(pairs: DataFrame) -> DataFrame:
    """All pairs of a left word in one text: right word, count and PMI in millionths, by right word."""
    maps = bigrams.stripes(pairs, "left_word", "right_word", ["n", "pmi"])
    entries = F.transform(
        F.map_entries("stripe"),
        lambda e: F.concat_ws(
            " ", e["key"], e["value"]["n"], F.round(e["value"]["pmi"] * 1_000_000).cast("bigint")
        ),
    )
    return maps.select(
        "left_word", F.size("stripe").cast("bigint").alias("n_right"), F.array_join(entries, "\n").alias("stripe")
    )


@query
def pmi_window(spark, sf):
    return _rounded(cooccur.pmi_window(text_lines(spark, sf)), "pmi")


def _rounded(rows: DataFrame, name: str, digits: int = 6) -> DataFrame:
    # Adding 0 turns a rounded -0.0 into 0.0.
    return rows.withColumn(name, F.round(name, digits) + F.lit(0.0))


# Inverted index and retrieval


@query
def inverted_index(spark, sf):
    return index.flat(index.inverted_index(text_lines(spark, sf))).select(
        "term", "df", "line_id", "tf"
    )


# Blocks narrow enough that the given documents fill many of them.
NARROW_BLOCK = 50 * LINES_PER_DOCUMENT


@query
def postings_gaps(spark, sf):
    blocks = stored(index.posting_blocks(text_lines(spark, sf), NARROW_BLOCK), "postings")
    return index.encode_gaps(blocks).select("term", F.inline("gaps"))


@query
def postings_gaps_decode(spark, sf):
    blocks = stored(index.posting_blocks(text_lines(spark, sf), NARROW_BLOCK), "postings")
    decoded = index.decode_gaps(stored(index.encode_gaps(blocks), "gaps"))
    return index.flat(decoded).select("term", "line_id", "tf")


def _stored_index(spark, lines):
    """An index in the store, of which a lookup reads the terms it needs."""
    path = fresh_path(spark, "index")
    indexes.write_index(index.posting_blocks(lines), path)
    return indexes.read_index(spark, path)


@query
def postings_lookup(spark, sf):
    blocks = _stored_index(spark, text_lines(spark, sf))
    return retrieval.postings_lookup(blocks, list(TERMS)).select("term", "line_id", "tf")


def _hits(spark, lines):
    return retrieval.boolean_retrieval(spark, _stored_index(spark, lines), BOOLEAN_QUERIES)


@query
def boolean_retrieval(spark, sf):
    return _hits(spark, text_lines(spark, sf))


@query
def fetch_snippets(spark, sf):
    lines = text_lines(spark, sf)
    return retrieval.fetch_snippets(_hits(spark, lines), lines)


# Graph


@query
def graph_nodes(spark, sf):
    records = graph.graph_nodes(
        trade_nodes(spark, sf), trade_edges(spark, sf, repeated=True), SOURCES
    )
    return records.select(
        "node_id",
        "slice",
        "out_degree",
        F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"),
        F.array_join(F.transform("ranks", lambda r: r.cast("int").cast("string")), ",").alias(
            "ranks"
        ),
    )


@query
def graph_stats(spark, sf):
    return graph.graph_stats(trade_nodes(spark, sf), trade_edges(spark, sf))


@query
def graph_partition(spark, sf):
    whole = graph.graph_nodes(trade_nodes(spark, sf), trade_edges(spark, sf, repeated=True), SOURCES)
    return graph.partition_report(graph.graph_partition(whole, 7))


@query
def graph_duplicate_nodes(spark, sf):
    # One record per bought line: parts bought more than once repeat.
    bought = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("node_id"))
    return graph.graph_duplicate_nodes(bought.unionAll(trade_nodes(spark, sf)))


def _one_step(spark, sf):
    """Links of the graph with unknown nodes, and the ranks after one iteration."""
    nodes = trade_nodes(spark, sf, small_parts=False)
    links = pagerank.prepare_links(nodes, trade_edges(spark, sf, repeated=True))
    start = pagerank.initial_ranks(nodes, SOURCES)
    return links, pagerank.ppr_iteration(links, start)


@query
def ppr_step(spark, sf):
    return _rounded(pagerank.ppr_step(*_one_step(spark, sf)), "mass", 8)


@query
def ppr_missing_mass(spark, sf):
    return _rounded(pagerank.ppr_missing_mass(*_one_step(spark, sf)), "missing", 8)


def _ranks(spark, sf):
    return pagerank.personalized_pagerank(
        trade_nodes(spark, sf), trade_edges(spark, sf), SOURCES, ITERATIONS
    )


@query
def personalized_pagerank(spark, sf):
    return _rounded(_ranks(spark, sf), "rank", 8)


@query
def personalized_pagerank_cyclic(spark, sf):
    nodes = trade_nodes(spark, sf).where("node_id % 3 < 2")  # customers and parts
    ranks = pagerank.personalized_pagerank(nodes, cyclic_edges(spark, sf), SOURCES, ITERATIONS)
    return _rounded(ranks, "rank", 8)


@query
def personalized_pagerank_unknown_nodes(spark, sf):
    nodes = trade_nodes(spark, sf, small_parts=False)
    edges = trade_edges(spark, sf, repeated=True)
    ranks = pagerank.personalized_pagerank(nodes, edges, SOURCES, ITERATIONS)
    return _rounded(ranks, "rank", 8)


@query
def personalized_pagerank_resumed(spark, sf):
    nodes, edges = trade_nodes(spark, sf), trade_edges(spark, sf)
    state = fresh_path(spark, "ranks")
    pagerank.personalized_pagerank(nodes, edges, SOURCES, 1, state=state)
    ranks = pagerank.personalized_pagerank(
        nodes, edges, SOURCES, ITERATIONS, state=state, start=1
    )
    return _rounded(ranks, "rank", 8)


@query
def personalized_pagerank_records(spark, sf):
    nodes, edges = trade_nodes(spark, sf, small_parts=False), trade_edges(spark, sf, repeated=True)
    laid = records.store_records(graph.graph_nodes(nodes, edges, SOURCES), SOURCES)
    return _rounded(records.flat_ranks(records.iterate(laid, ITERATIONS)), "rank", 8)


@query
def ppr_topk(spark, sf):
    # Ten digits of a rank do not depend on the order of summing.
    return _rounded(pagerank.ppr_topk(_rounded(_ranks(spark, sf), "rank", 10), 10), "rank", 5)


# Classifier


@query
def doc_features(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    features = F.transform(tokens("text"), hashed_feature)
    return classify.doc_features(documents, features)


@query
def shuffle_instances(spark, sf):
    return classify.shuffle_instances(instances(spark, sf), seed=1).select(
        "order_key", "doc_id", "label"
    )


def _training_sets(spark, sf):
    """Three training sets by document id, each in a seeded order."""
    return instances(spark, sf).select(
        (F.col("doc_id") % 3).cast("int").alias("model_id"),
        "*",
        classify.order_key(1).alias("order_key"),
    )


@query
def train_sgd(spark, sf):
    return _rounded(classify.train_sgd(_training_sets(spark, sf)), "weight", 8)


@query
def train_batch(spark, sf):
    return _rounded(classify.train_batch(instances(spark, sf), steps=2), "weight", 8)


def _scored(spark, sf):
    rows = instances(spark, sf)
    return _settled(classify.score_documents(rows, formula_models(rows, 3)))


def _settled(scored: DataFrame) -> DataFrame:
    """Scores to ten digits: noise from the order of summing must not show in the comparison."""
    return _rounded(scored, "score", 10).withColumn("answer", classify.answer(F.col("score")))


@query
def score_documents(spark, sf):
    return _rounded(_scored(spark, sf), "score")


@query
def ensemble_average(spark, sf):
    return _rounded(_settled(classify.ensemble_average(_scored(spark, sf))), "score")


@query
def ensemble_vote(spark, sf):
    return classify.ensemble_vote(_scored(spark, sf))


@query
def one_minus_roca(spark, sf):
    scored = _rounded(_scored(spark, sf), "score", 4)
    return _rounded(evaluate.one_minus_roca(scored), "one_minus_roca")


@query
def shuffle_trials(spark, sf):
    rows = instances(spark, sf)
    trials = classify.shuffle_trials(rows, rows, list(range(1, 11)), settle=_settled)
    return _rounded(trials, "one_minus_roca")


@query
def ensemble_stored(spark, sf):
    """Models trained, stored, and read back as the members of an ensemble."""
    path = fresh_path(spark, "models")
    training = _training_sets(spark, sf)
    sinks.write_models(classify.train_sgd(training), path)
    sets = stored(training.groupBy("model_id").agg(F.count("*").alias("documents")), "sets")
    models = sinks.read_ensemble(spark, path, sets.where("model_id <> 1"))
    scored = _settled(classify.score_documents(instances(spark, sf), models))
    return _rounded(_settled(classify.ensemble_average(scored)), "score")


# Streams


def _window_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("window_start", "window_end")}
    )


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def event_count_tumbling(spark, sf):
    return _window_columns(windows.event_count_tumbling(_events(spark, sf)))


@query
def event_count_tumbling_stream(spark, sf):
    def counts(stream):
        counted = streams.stream_window_count(stream, "ts", windows.COUNT_WINDOW, DELAY)
        return streams.stream_with_silent_windows(counted, HOURLY)

    return _window_columns(_replayed(spark, sf, "counts", counts))


@query
def region_event_count(spark, sf):
    events = _events(spark, sf)
    return _window_columns(windows.region_event_count(_located(events), clock=events))


@query
def region_event_count_stream(spark, sf):
    def located(events):
        # Named after the time of the event, the condition is not moved ahead of the watermark.
        region = regions.region_of(*event_point(), BOXES)
        here = F.when(F.col("ts").isNotNull(), region.isNotNull())
        return events.where(here).withColumn("region", region)

    def counts(stream):
        counted = streams.stream_window_count(
            stream, "ts", windows.COUNT_WINDOW, DELAY, "region", prepare=located
        )
        return streams.stream_with_silent_windows(counted, HOURLY, "region")

    return _window_columns(_replayed(spark, sf, "regions", counts))


def _history(spark, sf):
    per_type = windows.window_count(_events(spark, sf), "ts", HOUR, "event_type")
    return windows.window_state_history(per_type, "event_type", HOUR)


def _history_stream(spark, sf):
    def history(stream):
        per_type = streams.stream_window_count(stream, "ts", HOUR, DELAY, "event_type")
        return streams.stream_state_history(per_type, "event_type", HOURLY)

    return _replayed(spark, sf, "history", history)


@query
def window_state_history(spark, sf):
    return _window_columns(_history(spark, sf))


@query
def window_state_history_stream(spark, sf):
    return _window_columns(_history_stream(spark, sf))


@query
def trending_alerts(spark, sf):
    return _window_columns(windows.trending_alerts(_history(spark, sf), minimum=MIN_EVENTS))


@query
def trending_alerts_stream(spark, sf):
    history = _history_stream(spark, sf)
    return _window_columns(windows.trending_alerts(history, minimum=MIN_EVENTS))


@query
def sliding_window_count(spark, sf):
    return _window_columns(
        windows.sliding_window_count(_events(spark, sf), "60 minutes", "15 minutes")
    )


@query
def stream_recovery(spark, sf):
    """Counts of a stream that stops after each of three periods and starts again."""

    def counts(stream):
        counted = streams.stream_window_count(stream, "ts", windows.COUNT_WINDOW, DELAY)
        return streams.stream_with_silent_windows(counted, HOURLY)

    return _window_columns(_replayed(spark, sf, "recovery", counts, slices=3))
