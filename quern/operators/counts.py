"""Word counts over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.tokens import first_distinct, tokens


def tokenize_lines(lines: DataFrame) -> DataFrame:
    """``(line_id, pos, token)``, positions from 0."""
    return lines.select("line_id", F.posexplode(tokens("line")).alias("pos", "token"))


def first_k_distinct_tokens(lines: DataFrame, cut: int = 40) -> DataFrame:
    """``(line_id, token)``: distinct tokens among the first ``cut`` of each line."""
    return lines.select(
        "line_id", F.explode(first_distinct(tokens("line"), cut)).alias("token")
    )


def word_count(lines: DataFrame, min_count: int = 1) -> DataFrame:
    """``(token, n)`` over all tokens; ``min_count`` is applied to the final counts."""
    counts = (
        lines.select(F.explode(tokens("line")).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    return counts if min_count <= 1 else counts.where(F.col("n") >= min_count)


def line_doc_frequency(lines: DataFrame, cut: int | None = 40) -> DataFrame:
    """``(token, n)``: in how many lines a token occurs among the first ``cut``."""
    return (
        lines.select(F.explode(first_distinct(tokens("line"), cut)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def line_count(lines: DataFrame) -> DataFrame:
    """One row: the number of lines, empty ones included."""
    return lines.agg(F.count("*").alias("n"))


def top_terms(lines: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent tokens."""
    return word_count(lines).orderBy(F.desc("n"), "token").limit(limit)
