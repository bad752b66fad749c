"""Operators for training data: cleaning, deduplication, scoring and mixing of documents.

Every operator takes a DataFrame and returns one row per input row with two columns:
``row``, the input row as it came, whatever its columns are called, and ``out``, a struct
of what the operator found. Nothing outside this folder imports it.
"""
