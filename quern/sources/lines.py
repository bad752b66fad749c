"""Text as lines: the unit of counting, pairing and indexing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Room for line numbers within one document id: more than an array of lines can have.
LINES_PER_DOCUMENT = 1 << 31
MOST_DOCUMENT = (1 << 32) - 1


def scan_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, line_id, line)`` of a table of whole texts; a last newline ends the
    last line and opens no other.

    ``line_id`` is ``doc_id * 2**31 + line_no``: unique for unique document ids and ascending by
    document and line, however long a document is. Document ids are from -2**32 to 2**32 - 1; any
    other fails the job. A null id gives null line ids, a null text no lines."""
    number, line_no = F.col("doc_id").cast("bigint"), F.col("line_no")
    wrong = F.raise_error(F.lit("document id out of range for line ids")).cast("bigint")
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode(F.split(F.regexp_replace(text, r"\n\z", ""), "\n")).alias("line_no", "line"),
    ).select(
        "doc_id",
        "line_no",
        F.when(number.isNull() | number.between(-1 - MOST_DOCUMENT, MOST_DOCUMENT), number * LINES_PER_DOCUMENT + line_no)
        .otherwise(wrong)
        .alias("line_id"),
        "line",
    )


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, line_id, line)`` of text files, split by Spark wherever it likes.

    The id is unique and grows with the position inside a split. Write the lines out
    once when ids have to agree between separate jobs (indexing, then fetching).
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )
