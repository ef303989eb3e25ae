"""From raw documents to packed training sequences, a stage after the other.

Every stage takes the documents that its predecessor kept, from Parquet, and returns
documents with the same columns; the last returns where their pieces lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import fm_decontaminate, line_dedup, ngram_jaccard, packing, quality_gam
from cellframe.llm.common import find_package
from cellframe.scratch import scratch_dir, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    NULL and empty texts are scored like others, repeated rows alike; rows without an id stay.
    """
    find_package(spark)
    return quality_gam.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go.

    NULL texts and rows without an id stay as they are; a text without lines left is empty.
    """
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows one stays, that with the smallest id.

    Every row counts for itself: of rows with one id and different texts each stays or goes
    by its own text, and of equal rows one stays. Rows without an id stay; texts without
    words have no duplicates; an empty table stays empty.
    """
    find_package(spark)
    # Rows get their numbers once: the table is read again, not the frame.
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id IS NOT NULL")
    found = ngram_jaccard.near_duplicates(named.select(F.col("_row").alias("doc_id"), "text"))
    found = found.where("n_shingles > 0").join(
        named.select(F.col("_row").alias("doc_id"), F.col("doc_id").cast("bigint").alias("name")), "doc_id")
    first = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("name", "doc_id")).alias("first"))
    gone = stored(found.join(first.where("n > 1"), "component_id").where("doc_id <> first.doc_id").select(
        F.col("doc_id").alias("_row")), "near-duplicates")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    NULL and empty texts hold none; rows without an id stay.
    """
    find_package(spark)
    return fm_decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's pieces, packed into sequences.

    NULL texts count as empty, repeated rows as documents of their own; rows without an id
    are left out.
    """
    find_package(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Trained models, edit distances and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        path = scratch_dir(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
