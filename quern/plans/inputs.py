"""The given tables as inputs of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.features import hashed_feature
from quern.functions.regions import Box
from quern.functions.tokens import tokens
from quern.plans.scratch import stored
from quern.sources.files import PART_BYTES, shuffle_parts, size
from quern.sources.lines import scan_lines
from quern.sources.tables import scan_parquet

SPLIT_BYTES = 128 * 1024 * 1024
KINDS = ("customer", "part", "supplier")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan_parquet(spark, folder, name)


def spread(rows: DataFrame) -> DataFrame:
    """Deal out the rows of a table that is too small to give every core a split.

    A table with a split or more per core is left as it is, so this never moves more
    than one split per core.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = rows.inputFiles()
    if len(files) >= cores:
        return rows
    total = sum(size(spark, file) for file in files)
    # The work of a line can grow as its square, so a task has one part of the files at most.
    return rows.repartition(max(cores, -(-total // PART_BYTES))) if total < cores * SPLIT_BYTES else rows


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return scan_lines(spread(documents))


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def instances(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: label 1 for toxic ones, one hashed feature per token of the text."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    words = documents.join(labels, "doc_id")
    features = F.transform(tokens("text"), hashed_feature).alias("features")
    return stored(words.select("doc_id", "label", features), "instances")


def formula_models(rows: DataFrame, models: int) -> DataFrame:
    """Weights for every feature of the instances by a fixed rule, different per model."""
    features = rows.select(F.explode("features").alias("feature")).distinct()
    ids = F.explode(F.sequence(F.lit(1), F.lit(models)))
    weight = ((F.col("feature") * F.col("model_id")) % 201 - 100) / 1000.0
    return stored(
        features.select(ids.alias("model_id"), "feature").withColumn("weight", weight), "models"
    )


def node(key: str, kind: str) -> Column:
    """A node id that no key of another kind has, however many there are."""
    return F.col(key) * len(KINDS) + KINDS.index(kind)


def trade_edges(spark: SparkSession, folder: str, repeated: bool = False) -> DataFrame:
    """Customer -> part -> supplier links. Suppliers have no out-edges."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    # Explicit numbers of partitions: merged by their compressed size they would outgrow a task.
    parts = shuffle_parts(lines)
    joined = lines.repartition(parts, "l_orderkey").join(
        orders.repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    part = node("l_partkey", "part")
    buys = joined.select(node("o_custkey", "customer").alias("src"), part.alias("dst"))
    sold = lines.select(part.alias("src"), node("l_suppkey", "supplier").alias("dst"))
    if not repeated:
        buys = buys.repartition(parts, "src", "dst").distinct()
        sold = sold.repartition(parts, "src", "dst").distinct()
    return stored(buys.unionAll(sold), "edges")


def trade_nodes(spark: SparkSession, folder: str, small_parts: bool = True) -> DataFrame:
    """Node records of customers, parts and suppliers; without ``small_parts`` some are missing."""
    part = table(spark, folder, "part")
    if not small_parts:
        part = part.where("p_size <> 1")
    return (
        table(spark, folder, "customer")
        .select(node("c_custkey", "customer").alias("node_id"))
        .unionAll(part.select(node("p_partkey", "part")))
        .unionAll(table(spark, folder, "supplier").select(node("s_suppkey", "supplier")))
    )


def cyclic_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Customer <-> part links in both directions."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    pairs = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(node("o_custkey", "customer").alias("c"), node("l_partkey", "part").alias("p"))
        .distinct()
    )
    both = F.array(
        F.struct(F.col("c").alias("src"), F.col("p").alias("dst")),
        F.struct(F.col("p").alias("src"), F.col("c").alias("dst")),
    )
    return stored(pairs.select(F.inline(both)), "edges")


BOXES = (Box("west", 10, 40, 5, 50), Box("east", 80, 120, 20, 90))


def part_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """A box per part, of very different sizes, the first ones in the order of the keys."""
    key = F.col("p_partkey")
    x0, y0 = (key * 37 % 1000).cast("double"), (key * 91 % 500).cast("double")
    wide = F.when(key % 100 == 0, 300.0).otherwise(F.col("p_size") / F.lit(8.0))
    return table(spark, folder, "part").select(
        key.alias("place"),
        F.concat(F.lit("box "), key).alias("name"),
        x0.alias("x0"),
        (x0 + wide).alias("x1"),
        y0.alias("y0"),
        (y0 + wide / 2).alias("y1"),
    )


def event_point() -> tuple[Column, Column]:
    """Coordinates of an event: which column is which depends on the kind of event."""
    click = F.col("event_type") == "click"
    user = F.col("user_id").cast("double")
    return F.when(click, user).otherwise(F.col("value")), F.when(
        click, F.col("value")
    ).otherwise(user)
