"""The query registry and the frames several queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe import unpivot_to_cells
from cellframe.session import spread_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a function under a name, with the SQL it must agree with."""
    def register(function):
        QUERIES[name], ORACLES[name] = function, sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cells: a row per user, a qualifier per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"),
        F.lit("event").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.col("value").cast("string").cast("binary").alias("value"),
        micros("ts").alias("ts"),
        F.col("event_id").alias("seq"))


# The family each part column is kept in.
PART_FAMILIES = {
    "p_name": "base", "p_brand": "base", "p_type": "detail", "p_size": "detail", "p_retailprice": "detail"}


def part_cells(spark: SparkSession, sf_dir: str, versions: int = 1) -> DataFrame:
    """Parts as cells in two families; earlier versions hold other values."""
    part = spread_rows(table(spark, sf_dir, "part"), len(PART_FAMILIES) * versions)
    newest = unpivot_to_cells(part, "p_partkey", PART_FAMILIES, list(PART_FAMILIES), ts=F.lit(versions))
    if versions == 1:
        return newest
    older = newest.withColumn("value", F.lit("7").cast("binary")).withColumn(
        "ts", F.explode(F.sequence(F.lit(1), F.lit(versions - 1)).cast("array<bigint>")))
    return older.unionByName(newest)
