"""Whole jobs, from input files to output files, read back for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe import read_orc, read_rows, read_sequence
from cellframe.plans import jobs
from cellframe.plans.manifest import freeze
from cellframe.scratch import scratch_dir
from cellframe.sinks.files import write_partition, write_tsv

from .registry import ORACLES, event_cells, part_cells, query, table

_NAMES = {"CLICK": "click", "Purchase": "purchase"}


@query("job_cells_to_orc", f"SELECT click, purchase FROM ({ORACLES['assemble_required']})")
def job_cells_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "cells-orc")
    cells = event_cells(spark, sf_dir)
    freeze(cells.withColumn("value", F.lit("7").cast("binary")), root, "shop:events", "1", ["event"])
    freeze(cells, root, "shop:events", "2", ["event"])
    cells = jobs.latest_cells(spark, root, "shop:events", ["event"])
    jobs.cells_to_orc(cells, _NAMES, "click", f"{root}/out", num_files=2)
    return read_orc(spark, f"{root}/out")


@query("job_cells_to_sequence", f"SELECT line AS value FROM ({ORACLES['assemble_tsv']})")
def job_cells_to_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "cells-sequence")
    jobs.cells_to_sequence(event_cells(spark, sf_dir), "signup", "error", path)
    return read_sequence(spark, path)


@query("job_cells_to_text", f"SELECT qualifier || chr(9) || value AS value FROM ({ORACLES['dump_pairs']})")
def job_cells_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "cells-text")
    jobs.cells_to_text(part_cells(spark, sf_dir), path, num_files=2)
    return spark.read.text(path)


@query("job_running_rows_to_orc", f"SELECT click, purchase FROM ({ORACLES['running_row']})")
def job_running_rows_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "running-orc")
    jobs.running_rows_to_orc(event_cells(spark, sf_dir), _NAMES, path)
    return read_orc(spark, path)


@query("job_rows_to_orc", f"SELECT click, purchase FROM ({ORACLES['assemble_from_rows']})")
def job_rows_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "rows-orc")
    read_rows(event_cells(spark, sf_dir)).write.parquet(f"{root}/rows")
    jobs.rows_to_orc(spark.read.parquet(f"{root}/rows"), _NAMES, f"{root}/out")
    return read_orc(spark, f"{root}/out")


@query("job_count_words", f"SELECT word || chr(9) || CAST(n AS VARCHAR) AS value FROM ({ORACLES['word_count']})")
def job_count_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "words")
    table(spark, sf_dir, "documents").select("text").write.text(f"{root}/in")
    jobs.count_words(spark, f"{root}/in", f"{root}/out")
    return spark.read.text(f"{root}/out")


def _write_merge_inputs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Customers, and orders in time order, so that the last line is the last order."""
    write_tsv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), f"{root}/customer")
    orders = table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey")
    write_tsv(orders.select("o_custkey", F.col("o_totalprice").cast("int").alias("score")), f"{root}/score")


@query("job_merge_records", f"""
SELECT CAST(id AS VARCHAR) || chr(9) || label || chr(9) || CAST(score AS VARCHAR) AS value
FROM ({ORACLES['merge_by_key']})""")
def job_merge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "merge-records")
    _write_merge_inputs(spark, sf_dir, root)
    info = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    score = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("score", T.IntegerType())])
    jobs.merge_records(spark, f"{root}/customer", f"{root}/score", info, score, "id", "name", "score", f"{root}/out")
    return spark.read.text(f"{root}/out")


@query("job_merge_lines", f"""
SELECT id || chr(9) || name || chr(9)
         || CASE WHEN score = 'null' THEN score ELSE CAST(CAST(trunc(CAST(score AS DOUBLE)) AS INTEGER) AS VARCHAR) END
       AS value
FROM ({ORACLES['merge_as_map']})""")
def job_merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "merge-lines")
    _write_merge_inputs(spark, sf_dir, root)
    jobs.merge_lines(spark, f"{root}/customer", f"{root}/score", ["id", "name", "segment"], ["id", "score"],
                     ["id", "name", "score"], f"{root}/out", missing="null")
    return spark.read.text(f"{root}/out")


@query("job_join_tables", """
SELECT CAST(o_orderkey AS VARCHAR) AS itemnumber, o_orderpriority AS itemgroupid, l_returnflag AS countrycode
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def job_join_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "join-tables")
    base = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("itemnumber"), F.col("o_orderpriority").alias("itemgroupid"))
    price = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("itemnumber"), F.col("l_returnflag").alias("countrycode"))
    for name, df in (("ItemBase", base), ("ItemPrice", price)):
        write_partition(df, root, name, "dt", "2018-09-29-08-28-33")
        write_partition(df.withColumn(df.columns[1], F.lit("other")), root, name, "dt", "2018-09-30-08-28-33")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("itemnumber", "itemgroupid", "countrycode")])
    jobs.join_tables(spark, f"{root}/ItemBase", f"{root}/ItemPrice", "itemnumber", "2018-09-29-08-28-33", schema,
                     f"{root}/out")
    return read_orc(spark, f"{root}/out")
