"""Inverted index, gap coding, stored index and Boolean retrieval."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quern.operators import index, retrieval
from quern.plans.scratch import stored
from quern.sources import bucketed, index_store

LINES = {
    3: "the cat the dog", 7: "a dog", 20: "the end of the line", 25: "", 41: "cat and dog and the",
}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(list(LINES.items()), "line_id bigint, line string")


@pytest.fixture(scope="module")
def blocks(lines):
    return stored(index.posting_blocks(lines, block=10))


def listing(frame):
    return {(r.term, r.line_id, r.tf) for r in frame.collect()}


def expected():
    return {
        (w, i, line.split().count(w)) for i, line in LINES.items() for w in line.split()
    }


def test_postings(lines, blocks):
    assert listing(index.flat(blocks)) == expected()
    for row in blocks.collect():
        ids = [p.line_id for p in row.postings]
        assert ids == sorted(ids) and {i // 10 for i in ids} == {row.block}
    df = {(r.term, r.df) for r in index.inverted_index(lines, block=10).collect()}
    assert df == {(w, sum(w in x.split() for x in LINES.values())) for w, *_ in expected()}


def test_gaps(blocks):
    encoded = stored(index.encode_gaps(blocks))
    gaps = {}
    for row in encoded.orderBy("term", "block").collect():
        gaps.setdefault(row.term, []).extend(g.gap for g in row.gaps)
    assert gaps["the"] == [3, 17, 21] and gaps["dog"] == [3, 4, 34]
    assert listing(index.flat(index.decode_gaps(encoded))) == expected()


def test_stored_index(spark, blocks, tmp_path):
    path = str(tmp_path)
    for per_slice in (2_000_000, 1):
        index_store.write_index(blocks, path, parts=3, postings_per_slice=per_slice)
        again = index_store.read_index(spark, path)
        assert listing(index.flat(again.blocks)) == expected()
        assert again.dictionary.where("term = 'the'").first().asDict() == {
            "term": "the", "df": 3, "slices": 1 if per_slice > 1 else 3,
        }
        for terms in (["cat", "nowhere"], ["the", "cat"], []):
            found = retrieval.postings_lookup(again, terms)
            assert listing(found) == {e for e in expected() if e[0] in terms}
    # A session that does not know the table opens it from its layout.
    spark.sql(f"DROP TABLE {bucketed.table_name(path + '/postings')}")
    assert listing(index.flat(index_store.read_index(spark, path).blocks)) == expected()


QUERIES = {
    "and": "cat dog AND", "or": "cat end OR", "nest": "a cat OR dog AND the AND",
    "none": "nowhere dog AND", "one": "dog", "upper": "Cat",
}


def test_boolean_queries(spark, blocks):
    got = retrieval.boolean_retrieval(spark, blocks, QUERIES)
    hits = {}
    for row in got.collect():
        hits.setdefault(row.query_id, set()).add(row.line_id)
    assert hits == {"and": {3, 41}, "or": {3, 20, 41}, "nest": {3, 41}, "one": {3, 7, 41}}
    by_range = retrieval.boolean_retrieval(spark, blocks, QUERIES, block_literals=1)
    assert sorted(map(tuple, by_range.collect())) == sorted(map(tuple, got.collect()))


def test_a_rare_term_decides_which_blocks_are_read(spark, tmp_path):
    texts = [(i, "the of" + (" rare" if i % 500 == 7 else "") + (" odd" if i == 9 else "")) for i in range(2000)]
    lines = spark.createDataFrame(texts, "line_id bigint, line string")
    index_store.write_index(index.posting_blocks(lines, block=10), str(tmp_path))
    found = index_store.read_index(spark, str(tmp_path))
    for text, blocks, hits in (("the of AND rare AND", 4, 4), ("rare odd OR the AND", 4, 5), ("the of AND", 200, 2000)):
        asked = retrieval.Queries({"q": text})
        assert retrieval.candidate_blocks(spark, found, asked).count() == blocks
        rows = retrieval.candidate_postings(spark, found, asked)
        per_block = {"the of AND rare AND": 3, "the of AND": 2}
        if text in per_block:
            assert rows.count() == blocks * per_block[text]
        assert retrieval.boolean_retrieval(spark, found, {"q": text}).count() == hits


def test_many_terms_need_several_masks(spark):
    rng = random.Random(3)
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]
    texts = [" ".join(words) if i == 5 else " ".join(rng.sample(words, 140)) for i in range(20)]
    lines = spark.createDataFrame(list(enumerate(texts)), "line_id bigint, line string")
    every = " ".join(words) + " AND" * (len(words) - 1)
    got = retrieval.boolean_retrieval(spark, index.posting_blocks(lines), {"q": every})
    assert [r.line_id for r in got.collect()] == [5]


@pytest.mark.parametrize("postfix", ["AND", "cat AND", "cat dog", ""])
def test_malformed_query(spark, blocks, postfix):
    with pytest.raises(ValueError):
        retrieval.boolean_retrieval(spark, blocks, {"q": postfix})


def test_snippets(spark):
    lines = spark.createDataFrame(
        [(1, "x" * 80), (2, "y" * 81), (3, "z")], "line_id bigint, line string"
    )
    hits = lines.select("line_id").where("line_id < 3")
    got = {r.line_id: r.snippet for r in retrieval.fetch_snippets(hits, lines).collect()}
    assert got == {1: "x" * 80, 2: "y" * 80 + "..."}


def test_postings_take_one_shuffle(lines):
    plan = index.posting_blocks(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_lookup_opens_only_the_buckets_of_its_terms(spark, blocks, tmp_path):
    index_store.write_index(blocks, str(tmp_path / "index"), parts=16)
    found = retrieval.postings_lookup(index_store.read_index(spark, str(tmp_path / "index")), ["dog", "zebra"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(place, [dog 0,zebra 0])" in plan
    # Buckets are pruned whether or not a scan keeps them apart; the plan says so only if it does.
    automatic = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(automatic, "false")
    try:
        apart = retrieval.postings_lookup(index_store.read_index(spark, str(tmp_path / "index")), ["dog", "zebra"])
        plan = apart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(automatic)
    assert re.search("SelectedBucketsCount: [12] out of 16", plan)
    assert listing(found) == {("dog", 3, 1), ("dog", 7, 1), ("dog", 41, 1)}


def test_decoding_makes_no_row_per_posting(spark):
    """Blocks are decoded as they are: not taken apart, summed by a window and collected again."""
    lines = spark.createDataFrame([(i, "a b a") for i in range(30)], "line_id bigint, line string")
    encoded = index.encode_gaps(stored(index.posting_blocks(lines, 7))).localCheckpoint()
    decoded = index.decode_gaps(encoded)
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan
    assert {(r.term, r.line_id, r.tf) for r in index.flat(decoded).collect()} == {
        (term, i, tf) for term, tf in (("a", 2), ("b", 1)) for i in range(30)
    }
