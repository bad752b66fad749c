"""The operators bound to the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import language_model
from quern.llm.decontaminate import decontaminate
from quern.llm.hard_negatives import hard_negatives
from quern.llm.mixture import mix_sources, word_count
from quern.llm.near_duplicates import near_duplicate_classes
from quern.llm.near_vectors import near_duplicate_vectors
from quern.llm.quotations import link_quotations
from quern.llm.spelling import spelling_variants, words_with_slips
from quern.llm.substring_dedup import remove_repeated_passages
from quern.llm.suffix_dedup import remove_repeated_bytes
from quern.llm.token_files import read_token_files, write_token_files
from quern.llm.toxicity import score, train
from quern.llm.wrappers import extract_main_text
from quern.sources.tables import scan_parquet

Query = Callable[[SparkSession, str], DataFrame]


def op1_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return link_quotations(scan_parquet(spark, folder, "conversations")).select(
        "row.conv_id", "row.turn", "row.role", "out.quote_levels", "out.n_quoted", "out.n_linked",
        "out.parent_turn", "out.root_turn", "out.depth", "out.own_text",
    )


def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    return remove_repeated_bytes(docs, keep_bytes=False).select(
        "row.doc_id", "out.n_bytes", "out.n_removed", "out.n_spans", "out.kept_sha256"
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    model = train(docs, scan_parquet(spark, folder, "labels"))
    return score(docs, model).select("row.doc_id", "out.severity", "out.grade", "out.p_toxic")


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    return decontaminate(docs, scan_parquet(spark, folder, "benchmark"), clean=False).select(
        "row.doc_id", "out.n_words", "out.n_hit", "out.n_items", "out.items_sha256", "out.contaminated", "out.longest"
    )


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    held = language_model.held_out(F.col("doc_id"))
    model = language_model.train(docs.where(~held))
    return language_model.score(docs, model).withColumnRenamed("id", "doc_id").withColumn("held_out", held)


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    return remove_repeated_passages(docs, keep_text=False).select(
        "row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256"
    )


def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    vectors = scan_parquet(spark, folder, "embeddings").select("vec_id", "embedding")
    return near_duplicate_vectors(vectors).select("row.vec_id", "out.n_links", "out.component_id", "out.kept")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = scan_parquet(spark, folder, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, with_wrapper=False).select("row.page_id", "row.url", "out.text", "out.n_chars")


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix of documents; labelled quality weighs 1 if good, 0.25 if bad, 0.7 if unknown."""
    known = labels.groupBy("doc_id").agg(F.avg("quality").alias("known"))
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    quality = F.coalesce(0.25 + 0.75 * F.col("known"), F.lit(0.7)).alias("quality")
    weighed = sized.join(known, "doc_id", "left").select("doc_id", "source", "size", quality)
    return mix_sources(weighed, quality_col="quality").select(
        "row.doc_id", "out.size", "out.source_size", "out.target", "out.taken"
    )


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(scan_parquet(spark, folder, "documents"), scan_parquet(spark, folder, "labels"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(words_with_slips(scan_parquet(spark, folder, "documents").select("doc_id", "text")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = scan_parquet(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = scan_parquet(spark, folder, "documents").select("doc_id", "text")
    return read_token_files(write_token_files(docs, public_tokenizers.path("word_bpe_49k.json")))


def queries() -> dict[str, Query]:
    named = (
        op1_quotation_linking,
        op2_suffix_array_dedup,
        op3_toxicity,
        op4_benchmark_decontamination,
        op5_lm_scoring,
        op6_ngram_jaccard_join,
        op7_substring_dedup,
        op8_mix_sources,
        op9_embedding_near_dedup,
        op10_html_extraction,
        op11_spelling_variants,
        op12_hard_negatives,
        op13_token_files,
    )
    return {q.__name__: q for q in named}


MIX_SQL = """
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), known AS (SELECT doc_id, avg(quality) AS known FROM labels GROUP BY doc_id
), keys AS MATERIALIZED (
  SELECT d.doc_id, source, size,
    -ln((('0x' || substr(md5(d.doc_id::VARCHAR || '/mix'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
      / coalesce(0.25 + 0.75 * known, 0.7) AS key
  FROM sized d LEFT JOIN known USING (doc_id)
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, source_size * 3.0::DOUBLE AS most, most / weight AS full_at,
    (sum(source_size) OVER ()
      - coalesce(sum(most) OVER (ORDER BY full_at, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY full_at, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), plan AS (
  SELECT source, source_size,
    least(coalesce(weight * (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at), most), most) AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
    target - epochs * source_size AS rest
  FROM plan
), ahead AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, epochs, rest,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keys k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + CASE WHEN before < rest AND before + size - rest <= rest - before THEN size ELSE 0 END)::BIGINT AS taken
FROM ahead
"""


HARD_NEGATIVES_SQL = """
WITH vectors AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM vectors a JOIN vectors r ON len(a.q) = len(r.q) AND a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_mix_sources": MIX_SQL, "op12_hard_negatives": HARD_NEGATIVES_SQL}
