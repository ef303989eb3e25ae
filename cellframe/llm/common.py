"""Helpers that several operators of this package use."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import remove_dir, scratch_dir, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package, whatever folder the session was started in."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (environment.get("PYTHONPATH"), root)))


def query(name: str, sql: str | None = None):
    """Register a function as a query, with its SQL counterpart if there is one."""
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` alone; rows without an id cannot be named and go."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *more).where("doc_id IS NOT NULL")


def remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of an id's text, modulo ``divisor``: the folds of held-out rows."""
    return F.crc32(F.col(column).cast("string")) % divisor


def tasks_for(docs: DataFrame, task_bytes: int = 32 << 20) -> int:
    """Tasks so that each gets about ``task_bytes`` of the text, by Spark's estimate of it.

    Where Spark knows no size, as of rows that are in no file, the texts are measured.
    """
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return int(max(least, -(-size // task_bytes)))


class Scratch:
    """Tables of one job in the shared folder, which go as soon as nothing reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths, self.count = spark, scratch_dir(spark, name), {}, 0

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """The frame written under a name that is free, and read back."""
        self.count += 1
        path = self.paths[name] = f"{self.root}/{self.count}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_dir(self.spark, self.paths.pop(name))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node on an edge ``a, b``; the smallest node names it.

    Alternating large-star and small-star steps: each replaces a node's links by links
    to its smallest neighbour until nothing changes. Every step is two shuffles of the
    links; a node with many links is split by adaptive execution, as it is only joined
    to one row. Self links and null ends are ignored; without links the result is empty.
    """
    spark = edges.sparkSession
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = scratch_dir(spark, "links")
    links.write.parquet(path)
    links, before = spark.read.schema(links.schema).parquet(path), None
    while True:
        now = _fingerprint(links)
        if now == before or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))))
            .alias("e")).select("e.*").where("a <> b").distinct()
        following = scratch_dir(spark, "links")
        small.write.parquet(following)
        remove_dir(spark, path)
        path, links = following, spark.read.schema(small.schema).parquet(following)


# Odd multipliers and shifts of the 64-bit mixer.
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    first, second, shift = _MIX
    values = (values ^ (values >> shift)) * first
    values = (values ^ (values >> shift)) * second
    return values ^ (values >> shift)


_PRIME = 0x9E3779B97F4A7C15
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIME))
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    if size not in _POWERS:
        base = np.full(size, _PRIME, np.uint64)
        back = np.full(size, pow(_PRIME, -1, 1 << 64), np.uint64)
        base[0] = back[0] = 1
        _POWERS.clear()
        _POWERS[size] = np.multiply.accumulate(base), np.multiply.accumulate(back)
    up, down = _POWERS[size]
    return up[:n], down[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, in order."""
    codes = np.frombuffer(text, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64)
    edge = np.flatnonzero(np.diff(_SPACE[codes].view(np.int8), prepend=1, append=1))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[codes] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


__all__ = ["ORACLES", "QUERIES", "Scratch", "components", "find_package", "mixed", "query", "remainder", "remove_dir",
           "scratch_dir", "stored", "table", "tasks_for", "texts", "word_hashes"]
