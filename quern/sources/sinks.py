"""Writers that replace their output, and the stores read back by other jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



def write_text_table(rows: DataFrame, path: str, delimiter: str = "\t") -> None:
    """Rows as delimited text; what was at ``path`` before is replaced."""
    rows.write.mode("overwrite").option("sep", delimiter).csv(path)


def read_text_table(
    spark: SparkSession, path: str, schema: StructType | str, delimiter: str = "\t"
) -> DataFrame:
    return spark.read.schema(schema).option("sep", delimiter).csv(path)


def write_models(models: DataFrame, path: str) -> None:
    """``(model_id, feature, weight)``, one folder per model; any number of models.

    Rows are gathered by model so that small models do not fall into many files; a
    large one is split over several tasks.
    """
    models.hint("rebalance", F.col("model_id")).write.mode("overwrite").partitionBy("model_id").parquet(path)


def read_models(spark: SparkSession, path: str, model_ids: Sequence[int] | None = None) -> DataFrame:
    """The stored models, or those named: the others' folders are not read."""
    models = spark.read.parquet(path)
    return models if model_ids is None else models.where(F.col("model_id").isin(list(model_ids)))


def read_ensemble(spark: SparkSession, path: str, members: DataFrame) -> DataFrame:
    """The stored models that a table of members names by ``model_id``.

    The members are looked up while the query runs: the folders of other models are pruned then
    and not read, however the members were chosen.
    """
    return spark.read.parquet(path).join(F.broadcast(members.select("model_id")), "model_id", "left_semi")
