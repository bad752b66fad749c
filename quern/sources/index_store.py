"""An inverted index as bucketed tables: a lookup opens the buckets of its terms only.

Posting blocks are bucketed by ``place``, a term and a slice number, and sorted by place and block
in every bucket. A term has one slice unless its postings need several tasks; the few such
terms are listed beside the tables. An equality on ``place`` prunes buckets, so all but the
files of the wanted terms stay closed, and sorting lets a scan skip pages within them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.index import dictionary
from quern.plans.scratch import stored
from quern.plans.skew import ROWS_PER_SLICE, hot_keys, with_slice
from quern.sources.bucketed import open_bucketed, write_bucketed


@dataclass
class StoredIndex:
    """``blocks`` (place, term, block, postings), ``dictionary`` (term, df, slices), and ``hot``, the
    terms with several slices."""

    blocks: DataFrame
    dictionary: DataFrame
    hot: DataFrame

    def lookup(self, terms: list[str]) -> DataFrame:
        """``(term, block, postings)`` of the terms; the buckets of no others are opened.

        The terms come from the caller's program, and so have literals for their places.
        """
        rows = self.hot.where(F.col("term").isin(terms)).collect() if terms else []
        slices = {r.term: r.slices for r in rows}
        places = [f"{t} {i}" for t in terms for i in range(slices.get(t, 1))]
        wanted = F.col("place").isin(places) & F.col("term").isin(terms)
        return self.blocks.where(wanted).select("term", "block", "postings")


def write_index(
    blocks: DataFrame, path: str, parts: int | None = None, postings_per_slice: int = ROWS_PER_SLICE
) -> None:
    """Posting blocks and dictionary into ``parts`` buckets each; what was there is replaced."""
    spark = blocks.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(blocks, "postings")
    terms = stored(dictionary(blocks), "terms")
    hot = hot_keys(terms, "term", "df", postings_per_slice)
    hot.coalesce(1).write.mode("overwrite").parquet(f"{path}/hot")
    hot = spark.read.schema("term string, slices int").parquet(f"{path}/hot")
    placed = with_slice(blocks, "term", hot, ["block"]).select(
        F.concat_ws(" ", "term", "slice").alias("place"), "term", "block", "postings"
    )
    write_bucketed(placed, f"{path}/postings", parts, "place", "place", "block")
    sized = terms.join(F.broadcast(hot), "term", "left").select(
        "term", "df", F.coalesce("slices", F.lit(1)).alias("slices")
    )
    write_bucketed(sized, f"{path}/dictionary", parts, "term", "term")


def read_index(spark: SparkSession, path: str) -> StoredIndex:
    return StoredIndex(
        open_bucketed(spark, f"{path}/postings"),
        open_bucketed(spark, f"{path}/dictionary"),
        spark.read.schema("term string, slices int").parquet(f"{path}/hot"),
    )
