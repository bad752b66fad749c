"""Words to integer features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed_feature(word: str | Column) -> Column:
    """The first five hexadecimal digits of the word's MD5 sum as an integer."""
    text = F.col(word) if isinstance(word, str) else word
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("int")
