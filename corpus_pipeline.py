"""From raw documents to a training mix: five stages, each an operator of ``quern.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.decontaminate import decontaminate
from quern.llm.near_duplicates import without_near_duplicates
from quern.llm.queries import mixed
from quern.llm.substring_dedup import remove_repeated_passages
from quern.llm.tables import stored
from quern.llm.toxicity import score, train
from quern.plans.scratch import temporary
from quern.sources.tables import scan_parquet


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 0."""
    model = train(docs, scan_parquet(spark, sf_dir, "labels"))
    return score(docs, model).where("out.grade = 0").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return without_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; texts without one stay unchanged.

    A document of which nothing is left goes; ``n_chars`` follows the text.
    """
    found = remove_repeated_passages(docs)
    changed = F.col("out.n_removed") > 0
    text = F.when(changed, F.col("out.kept")).otherwise(F.col("row.text"))
    chars = F.when(changed, F.length("out.kept").cast("long")).otherwise(F.col("row.n_chars"))
    left = found.where(~changed | (F.col("out.n_removed") < F.col("out.n_words")))
    return left.select(*[{"text": text, "n_chars": chars}.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which test items cover less than a twentieth."""
    found = decontaminate(docs, scan_parquet(spark, sf_dir, "benchmark"), clean=False)
    return found.where(~F.col("out.contaminated")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixed(docs, scan_parquet(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", clean_language),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mix),
]
ORACLE_SQL = None  # no SQL for the fitted classifier; tests/llm tests every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; tables that only earlier stages needed are removed on the way."""
    docs = scan_parquet(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with temporary(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), "stage")
            made.pop()  # the stage's own table
    return STAGES[-1][1](spark, docs, sf_dir)
