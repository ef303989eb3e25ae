"""Labelled rows that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored, texts

MAX_EXAMPLES = 20_000


def examples(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int,
             most: int = MAX_EXAMPLES) -> DataFrame:
    """``doc_id, text, y`` of at most ``most`` labelled rows outside the held-out fold.

    They are those with the smallest hash of the id, so the sample is the same every
    time and follows no order of the table. Labels other than 0 and 1, and ids with
    both, are left out; a repeated row counts once.
    """
    known = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)")
    known = known.where(remainder("doc_id", divisor) != held_out).groupBy("doc_id").agg(
        F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("doc_id", "y")
    known = known.join(texts(docs).select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = stored(chosen, "examples")
    found = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most ``most`` ids
    # Of an id with several texts that with the smallest hash, whichever arrives first.
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select(
        "doc_id", "text", "y")
