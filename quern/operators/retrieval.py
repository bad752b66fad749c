"""Boolean retrieval over posting blocks, many queries at a time.

A query is decided twice. First over blocks: a block that lacks a term that the query cannot do
without holds no hit, and that needs the terms and numbers of blocks only. Then over the lines
of the blocks that are left. So a frequent term next to a rare one costs the blocks of the
rare one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.index import flat
from quern.plans.scratch import stored
from quern.sources.index_store import StoredIndex

AND, OR = "AND", "OR"
BITS = 62
SNIPPET = 80
# So many numbers of blocks become literals of the scan; more are joined and bounded by their range.
BLOCK_LITERALS = 1000


def query_terms(postfix: str) -> list[str]:
    """Distinct terms of a postfix query, in order."""
    return list(dict.fromkeys(w for w in postfix.split() if w not in (AND, OR)))


def _blocks_of(index: DataFrame | StoredIndex, terms: list[str]) -> DataFrame:
    if isinstance(index, StoredIndex):
        return index.lookup(terms)
    return index.where(F.col("term").isin(terms)).select("term", "block", "postings")


def postings_lookup(index: DataFrame | StoredIndex, terms: list[str]) -> DataFrame:
    """``(term, block, line_id, tf)`` of the given terms; absent terms give no rows.

    ``index`` is a stored index or any posting blocks. The terms come from the caller's program,
    so they are literals of a filter that reaches the scan.
    """
    return flat(_blocks_of(index, terms))


def _condition(postfix: str, has: Mapping[str, Column]) -> Column:
    """The Boolean column for a postfix query, given one column per term."""
    stack: list[Column] = []
    for word in postfix.split():
        if word not in (AND, OR):
            stack.append(has[word])
            continue
        if len(stack) < 2:
            raise ValueError(f"operator without two operands in query: {postfix!r}")
        right, left = stack.pop(), stack.pop()
        stack.append(left & right if word == AND else left | right)
    if len(stack) != 1:
        raise ValueError(f"query does not reduce to one result: {postfix!r}")
    return stack[0]


class Queries:
    """Postfix queries: one bit per distinct term of a query, in words of ``BITS`` bits."""

    def __init__(self, queries: Mapping[str, str]) -> None:
        self.texts = dict(queries)
        self.used = {query: query_terms(text) for query, text in queries.items()}
        self.words = max(1, max(((len(t) - 1) // BITS + 1 for t in self.used.values()), default=1))
        self.terms = sorted({term for terms in self.used.values() for term in terms})
        self.matches = F.lit(False)
        for query, text in queries.items():
            has = {
                term: F.col(f"mask_{position // BITS}").bitwiseAND(F.lit(1 << (position % BITS))) != 0
                for position, term in enumerate(self.used[query])
            }
            self.matches = self.matches | ((F.col("query_id") == query) & _condition(text, has))

    def bits(self, spark: SparkSession) -> DataFrame:
        """One row per term of the caller's own query strings."""
        rows = [
            (term, query, position // BITS, 1 << (position % BITS))
            for query, terms in self.used.items()
            for position, term in enumerate(terms)
        ]
        return spark.createDataFrame(rows, "term string, query_id string, word int, bit bigint")

    def matching(self, rows: DataFrame, place: str) -> DataFrame:
        """``(query_id, place)`` where the bits of ``rows`` fulfil the query. The bits are or-ed
        per (query, place) before and after the shuffle."""
        masks = [
            F.bit_or(
                F.when(F.col("word") == w, F.col("bit")).otherwise(F.lit(0).cast("bigint"))
            ).alias(f"mask_{w}")
            for w in range(self.words)
        ]
        found = rows.groupBy("query_id", place).agg(*masks)
        return found.where(self.matches).select("query_id", place)


def candidate_blocks(
    spark: SparkSession, index: DataFrame | StoredIndex, queries: Queries
) -> DataFrame:
    """``(query_id, block)``: the blocks that can hold hits, as a stored table. Reads no postings."""
    rows = _blocks_of(index, queries.terms).select("term", "block")
    return stored(queries.matching(rows.join(F.broadcast(queries.bits(spark)), "term"), "block"), "blocks")


def candidate_postings(
    spark: SparkSession,
    index: DataFrame | StoredIndex,
    queries: Queries,
    block_literals: int = BLOCK_LITERALS,
) -> DataFrame:
    """``(query_id, word, bit, postings)`` of the candidate blocks. Their numbers reach the scan as
    literals if there are at most ``block_literals``, else as a range; the join decides anyway."""
    blocks = candidate_blocks(spark, index, queries)
    few = [r.block for r in blocks.select("block").distinct().limit(block_literals + 1).collect()]
    if len(few) > block_literals:
        low, high = blocks.agg(F.min("block"), F.max("block")).first()
        near = F.col("block").between(low, high)
    else:
        near = F.col("block").isin(few)
    wanted = blocks.join(F.broadcast(queries.bits(spark)), "query_id")
    return (
        _blocks_of(index, queries.terms)
        .where(near)
        .join(wanted, ["term", "block"])
        .select("query_id", "word", "bit", "postings")
    )


def boolean_retrieval(
    spark: SparkSession,
    index: DataFrame | StoredIndex,
    queries: Mapping[str, str],
    block_literals: int = BLOCK_LITERALS,
) -> DataFrame:
    """``(query_id, line_id)`` for postfix queries of terms, ``AND`` and ``OR``.

    ``index`` is a stored index or any posting blocks. Writes the candidate blocks when called.
    """
    asked = Queries(queries)
    rows = candidate_postings(spark, index, asked, block_literals)
    lines = rows.select("query_id", "word", "bit", F.explode("postings.line_id").alias("line_id"))
    return asked.matching(lines, "line_id")


def fetch_snippets(hits: DataFrame, lines: DataFrame, width: int = SNIPPET) -> DataFrame:
    """Hits with their line, cut to ``width`` characters and ``...`` when longer.

    Lines are cut before the join, so no more than a snippet per line is shuffled.
    """
    short = F.when(
        F.length("line") > width, F.concat(F.substring("line", 1, width), F.lit("..."))
    ).otherwise(F.col("line"))
    return hits.join(lines.select("line_id", short.alias("snippet")), "line_id")
