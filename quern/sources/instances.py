"""Labelled sparse documents as text: ``docid label feature feature ...``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the positive label.
SPAM = "spam"


def scan_labelled_features(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(doc_id, label, features)``; label 1 for ``spam``, else 0; features in order.

    A document without features may end in a blank: an empty field is no feature."""
    fields = F.split(F.col(column), " ")
    features = F.slice(fields, F.lit(3), F.greatest(F.size(fields) - 2, F.lit(0)))
    return lines.select(
        fields.getItem(0).alias("doc_id"),
        (fields.getItem(1) == SPAM).cast("int").alias("label"),
        F.filter(features, lambda f: f != "").cast("array<int>").alias("features"),
    )
