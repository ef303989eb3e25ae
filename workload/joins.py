"""Queries over two inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe import (
    collect_sides, inner_join, merge_as_map, merge_by_key, parse_delimited, read_lines, side_counts, tag_source,
    tagged_union)
from cellframe.scratch import scratch_dir
from cellframe.sinks.files import write_tsv

from .registry import query, table

_LAST_ORDER = """
last_order AS (
  SELECT o_custkey, arg_max(o_totalprice, row(o_orderdate, o_orderkey)) AS price
  FROM orders GROUP BY o_custkey)"""


@query("merge_by_key", f"""
WITH {_LAST_ORDER},
scores AS (SELECT o_custkey, CAST(trunc(price) AS INTEGER) AS score FROM last_order)
SELECT coalesce(c_custkey, o_custkey) AS id,
       coalesce(c_name, '') || '_' || CASE WHEN score IS NULL THEN 'info' ELSE 'score' END
         || '_' || CAST(coalesce(score, 0) AS VARCHAR) AS label,
       coalesce(score, 0) AS score
FROM customer FULL JOIN scores ON c_custkey = o_custkey""")
def merge_customer_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    score = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").cast("int").alias("score"),
        "o_orderdate", "o_orderkey")
    return merge_by_key(info, score, "id", name="c_name", score_column="score",
                        info_order=["c_name"], score_order=["o_orderdate", "o_orderkey"])


@query("merge_as_map", f"""
WITH {_LAST_ORDER}
SELECT CAST(coalesce(c_custkey, o_custkey) AS VARCHAR) AS id, coalesce(c_name, 'null') AS name,
       coalesce(CAST(price AS VARCHAR), 'null') AS score
FROM customer FULL JOIN last_order ON c_custkey = o_custkey""")
def merge_customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(
        F.concat_ws("\t", "c_custkey", "c_name", "c_mktsegment").alias("value"), F.lit(0).alias("position"))
    right = table(spark, sf_dir, "orders").select(
        F.concat_ws("\t", "o_custkey", "o_totalprice").alias("value"),
        F.struct("o_orderdate", "o_orderkey").alias("position"))
    return merge_as_map(left, right, ["id", "name", "segment"], ["id", "score"], ["id", "name", "score"],
                        missing="null")


@query("inner_join_override", """
SELECT CAST(o_orderkey AS VARCHAR) AS itemnumber, o_orderpriority AS itemgroupid,
       l_returnflag AS status, CAST(l_quantity AS VARCHAR) AS quantity, '' AS countrycode
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def inner_join_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("itemnumber"), F.col("o_orderpriority").alias("itemgroupid"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("DT"))
    price = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("itemnumber"), F.col("l_returnflag").alias("status"),
        F.col("l_quantity").alias("quantity"), F.col("l_shipdate").alias("dt"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (
        "itemnumber", "itemgroupid", "status", "quantity", "countrycode")])
    return inner_join(base, price, ["itemnumber"], schema=schema, text=True)


@query("inner_join_large_keys", """
WITH flags AS (
  SELECT l_returnflag, l_linestatus AS status, count(*) AS n_lines FROM lineitem
  GROUP BY l_returnflag, l_linestatus)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_returnflag, f.status, f.n_lines
FROM lineitem l JOIN flags f ON l.l_returnflag = f.l_returnflag""")
def inner_join_large_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys hold all rows, left to adaptive execution."""
    lines = table(spark, sf_dir, "lineitem")
    flags = lines.groupBy("l_returnflag", F.col("l_linestatus").alias("status")).agg(
        F.count("*").alias("n_lines"))
    picked = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return inner_join(picked, flags, ["l_returnflag"])


@query("side_counts", """
SELECT coalesce(c_custkey, o_custkey) AS id, coalesce(n_info, 0) AS n_left,
       coalesce(n_score, 0) AS n_right, coalesce(n_info, 0) * coalesce(n_score, 0) AS n_joined
FROM (SELECT c_custkey, count(*) AS n_info FROM customer GROUP BY c_custkey)
FULL JOIN (SELECT o_custkey, count(*) AS n_score FROM orders GROUP BY o_custkey)
ON c_custkey = o_custkey""")
def count_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {
        "info": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
        "score": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))}
    return side_counts(tagged_union(sides), ["id"], "type", "info", "score")


@query("collect_sides", """
WITH sides AS (
  SELECT c_custkey AS id, 'info' AS type, c_name AS name, NULL::BIGINT AS number FROM customer
  UNION ALL SELECT o_custkey, 'score', NULL, o_orderkey FROM orders),
placed AS (SELECT *, row_number() OVER (PARTITION BY id, type ORDER BY number NULLS FIRST, name) - 1 AS n FROM sides)
SELECT id, type, n // 5 AS part, CAST(n % 5 AS INTEGER) AS place, name, number FROM placed""")
def list_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides' records of every customer in lists of five."""
    sides = {
        "info": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "score": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("number"))}
    lists = collect_sides(tagged_union(sides), ["id"], "type", ["number", "name"], list_size=5)
    return lists.select("id", "type", "part", F.posexplode("records").alias("place", "r")).select(
        "id", "type", "part", "place", "r.name", "r.number")


@query("collect_sides_large_keys", """
WITH placed AS (
  SELECT l_linestatus, l_returnflag, l_orderkey, l_partkey,
         row_number() OVER (PARTITION BY l_linestatus, l_returnflag
           ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS n FROM lineitem)
SELECT l_linestatus, l_returnflag, n // 1000 AS part, count(*) AS n_records, min(l_orderkey) AS first_order,
       max(l_orderkey) AS last_order, CAST(sum(l_partkey) AS BIGINT) AS parts
FROM placed GROUP BY l_linestatus, l_returnflag, n // 1000""")
def list_large_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys hold all records, in lists of a thousand."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", *order)
    lists = collect_sides(lines, ["l_linestatus"], "l_returnflag", order)
    return lists.select(
        "l_linestatus", "l_returnflag", "part", F.size("records").cast("bigint").alias("n_records"),
        F.element_at("records", 1)["l_orderkey"].alias("first_order"), F.element_at("records", -1)["l_orderkey"].alias("last_order"),
        F.aggregate("records", F.lit(0).cast("bigint"), lambda s, r: s + r["l_partkey"]).alias("parts"))


@query("tag_source_union", """
SELECT 'info' AS type, c_custkey AS id, c_name AS name, NULL::DOUBLE AS price FROM customer
UNION ALL SELECT 'score', o_custkey, NULL, o_totalprice FROM orders""")
def tag_text_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "tagged")
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    write_tsv(customer.select("c_custkey", "c_name"), f"{root}/customerinfo")
    write_tsv(orders.select("o_custkey", F.lit(""), "o_totalprice"), f"{root}/orderscore")
    lines = read_lines(spark, [f"{root}/customerinfo", f"{root}/orderscore"])
    tagged = tag_source(lines, {"customerinfo": "info", "orderscore": "score"})
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType())])
    rows = parse_delimited(tagged, schema, keep=["type"])
    return rows.withColumn("name", F.nullif("name", F.lit("")))
