"""Counting and last-record aggregates; all combine inside the scan tasks first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_split
from .ordered import scan


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each blank-separated token occurs, empty tokens included."""
    words = lines.select(F.explode(java_split(F.col(column), " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The record with the greatest ``order`` of every key."""
    rest = [c for c in df.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*key).agg(last).select(*key, "_last.*")


def side_counts(df: DataFrame, key: Sequence[str], tag: str, left: str, right: str) -> DataFrame:
    """Per key: records on each side of a tagged union, and rows their join makes.

    For the records themselves see ``collect_sides``.
    """
    sides = df.groupBy(*key).agg(
        F.count_if(F.col(tag) == left).alias("n_left"),
        F.count_if(F.col(tag) == right).alias("n_right"))
    return sides.withColumn("n_joined", F.col("n_left") * F.col("n_right"))


def collect_sides(df: DataFrame, key: Sequence[str], tag: str, order: Sequence[str], *,
                  list_size: int = 1000, chunks: int | None = None) -> DataFrame:
    """Each key's records of each side as numbered lists of at most ``list_size``.

    ``df`` is a tagged union; the result has the key, the tag, ``part`` from 0 and
    ``records`` in ``order``, the other columns as structs. Records are numbered by ranges
    of key and order, so no task holds a key's records, however many there are; every list
    but the last one of a side is full. ``order`` should be unique within a side of a key;
    records that are equal in it come in the order of their hashes.
    """
    rest = [c for c in df.columns if c not in (*key, tag)]
    ranked = df.withColumn("_rank", F.xxhash64(*[F.col(f"`{c}`") for c in rest]))
    numbered = scan(ranked, [*key, tag], [*order, "_rank"], number="_number", chunks=chunks)
    part = F.floor((F.col("_number") - 1) / list_size).cast("bigint").alias("part")
    entry = F.struct("_number", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("record"))
    lists = numbered.select(*key, tag, part, entry.alias("entry")).groupBy(*key, tag, "part").agg(
        F.sort_array(F.collect_list("entry")).alias("entries"))
    return lists.select(*key, tag, "part", F.transform("entries", lambda e: e["record"]).alias("records"))
