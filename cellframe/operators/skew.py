"""Salting of keys that hold a large share of all rows, for sessions without adaptive execution.

Keys are compared by a 64-bit hash: a collision only spreads a key that did not need it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key])


def hot_keys(df: DataFrame, key: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """``_hot, _salts``: hashes of the keys with more than ``hot_rows`` rows.

    ``_salts`` is how many tasks of ``hot_rows`` rows a key needs. By default a key is
    hot if it has more than one shuffle partition's share of all rows, so there are
    never more hot keys, nor more salts for one, than shuffle partitions. Only the key
    columns are read and counts are combined inside each task.
    """
    counts = df.select(key_hash(key).alias("_hot")).groupBy("_hot").agg(F.count("*").alias("_n"))
    if hot_rows is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot_rows = -(-df.count() // parts)
    hot_rows = max(hot_rows, 1)
    return counts.where(F.col("_n") > hot_rows).select("_hot", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))


def spread_number(df: DataFrame) -> Column:
    """A number that differs between rows, and between copies in different partitions.

    It depends on a row's content and on the partition the row was read in, not on
    random numbers or row order, so a task that runs again gives the same numbers.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.hash(F.spark_partition_id(), content)
