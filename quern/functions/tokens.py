"""Lines to tokens.

A token is a blank-separated word in lower case without the characters other than
a-z at its two ends; words without any a-z are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[ \t\n\r\f]+"
# From the first to the last a-z of a blank-separated word. One search over the line finds all
# tokens; a word is read to its end once and back to its last a-z, which is linear.
TOKEN = r"[a-z](?:[^ \t\n\r\f]*[a-z])?"


def _column(text: str | Column) -> Column:
    return F.col(text) if isinstance(text, str) else text


def tokens(line: str | Column) -> Column:
    """All tokens of a line, in order."""
    return F.regexp_extract_all(F.lower(_column(line)), F.lit(TOKEN), F.lit(0))


def raw_words(line: str | Column) -> Column:
    """Blank-separated words as they stand."""
    return F.filter(F.split(_column(line), BLANKS), lambda w: w != "")


def first_distinct(words: str | Column, cut: int | None = None) -> Column:
    """Distinct words among the first ``cut`` of an array, or of all of them."""
    array = _column(words)
    return F.array_distinct(array if cut is None else F.slice(array, 1, cut))
