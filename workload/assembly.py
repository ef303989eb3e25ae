"""Queries that turn cells into rows, dumps and counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe import (
    ColumnSpec, assemble, assemble_from_pieces, assemble_from_rows, assemble_keyed, assemble_strings, assemble_tsv,
    dump_pairs, last_per_key, read_keyed_cells, read_row_pieces, read_rows, running_row, scan, word_count,
    write_keyed_cells)
from cellframe.operators.select import (
    cells_to_pairs, drop_empty_rows, families, key_range, map_columns, show_cells)
from cellframe.scratch import scratch_dir

from .registry import PART_FAMILIES, event_cells, part_cells, query, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _part_specs(**types: str) -> list[ColumnSpec]:
    return [ColumnSpec(PART_FAMILIES[name], name, kind, name) for name, kind in types.items()]


def _latest(kind: str, cast: str = "{}") -> str:
    newest = f"arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = '{kind}')"
    return f"{cast.format(newest)} AS {kind}"


@query("assemble_latest", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, {', '.join(_latest(k) for k in EVENT_TYPES)}
FROM events GROUP BY user_id""")
def assemble_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [ColumnSpec("event", k, "double", k) for k in EVENT_TYPES]
    return assemble(event_cells(spark, sf_dir), specs)


@query("assemble_roundtrip_typed", """
SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name, p_size, p_retailprice,
       CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS VARCHAR) AS price, '20240101000000000' AS dt
FROM part""")
def assemble_roundtrip_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _part_specs(p_name="string", p_size="int", p_retailprice="double")
    # One source column under two names.
    specs.append(ColumnSpec("detail", "p_retailprice", "decimal(12,2)", "price"))
    rows = assemble(part_cells(spark, sf_dir, versions=2), specs, partition=("dt", "20240101000000000"))
    return rows.withColumn("price", F.col("price").cast("string"))


@query("assemble_wide", """
SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def assemble_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _part_specs(
        p_name="string", p_brand="varchar(10)", p_type="char(25)", p_size="smallint", p_retailprice="double")
    rows = assemble(part_cells(spark, sf_dir, versions=3), specs, wide=True)
    return rows.withColumn("p_size", F.col("p_size").cast("int"))


@query("assemble_two_families", "SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name, p_type, p_size FROM part")
def assemble_two_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = part_cells(spark, sf_dir, versions=2)
    both = families(cells, "base").unionByName(families(cells, "detail"))
    return assemble(both, _part_specs(p_name="string", p_type="string", p_size="int"))


@query("assemble_required", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, {_latest('click', 'CAST({} AS VARCHAR)')},
       {_latest('purchase', 'CAST({} AS VARCHAR)')}
FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'click') > 0""")
def assemble_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"CLICK": "click", "Purchase": "purchase"}
    return assemble_strings(event_cells(spark, sf_dir), names, required="click")


@query("assemble_tsv", """
WITH newest AS (
  SELECT arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = 'signup') AS k,
         arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = 'error') AS v
  FROM events GROUP BY user_id)
SELECT CAST(k AS VARCHAR) || chr(9) || coalesce(CAST(v AS VARCHAR), '') AS line
FROM newest WHERE k IS NOT NULL""")
def assemble_tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_tsv(event_cells(spark, sf_dir), "Signup", "Error")


@query("assemble_from_rows", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, {', '.join(_latest(k, 'CAST({} AS VARCHAR)') for k in EVENT_TYPES)}
FROM events GROUP BY user_id""")
def assemble_grouped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_rows(event_cells(spark, sf_dir))
    return assemble_from_rows(drop_empty_rows(rows), {k.upper(): k for k in EVENT_TYPES})


@query("read_rows", """
WITH newest AS (
  SELECT user_id, event_type, max(row(ts, event_id)) AS version,
         arg_max(value, row(ts, event_id)) AS value
  FROM events GROUP BY user_id, event_type)
SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier, CAST(value AS VARCHAR) AS value,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY version) - 1 AS INTEGER) AS place
FROM newest""")
def grouped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_rows(event_cells(spark, sf_dir))
    return rows.select("row_key", F.posexplode("cells").alias("place", "cell")).select(
        "row_key", "cell.qualifier", F.col("cell.value").cast("string").alias("value"), "place")


def _keyed(spark: SparkSession, cells: DataFrame, buckets: int):
    """Cells written as a table by row key, and read again."""
    name = f"cells_{uuid.uuid4().hex}"
    write_keyed_cells(cells, name, scratch_dir(spark, "keyed"), buckets)
    return read_keyed_cells(spark, name)


@query("assemble_keyed", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, {', '.join(_latest(k) for k in EVENT_TYPES)}
FROM events GROUP BY user_id""")
def assemble_keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from a table by row key, without a shuffle where no key is larger than a bucket."""
    specs = [ColumnSpec("event", k, "double", k) for k in EVENT_TYPES]
    return assemble_keyed(_keyed(spark, event_cells(spark, sf_dir), 8), specs)


_LINE_KEY = "CASE WHEN l_returnflag = 'N' THEN 'N' ELSE CAST(l_orderkey AS {}) END"
_LINE_VERSION = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query("assemble_keyed_large_keys", f"""
SELECT {_LINE_KEY.format('VARCHAR')} AS row_key,
       arg_max(l_partkey, row({_LINE_VERSION})) FILTER (WHERE l_linestatus = 'O') AS open_part,
       arg_max(l_partkey, row({_LINE_VERSION})) FILTER (WHERE l_linestatus = 'F') AS filled_part
FROM lineitem GROUP BY ALL""")
def assemble_keyed_large_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row key holds about half of all cells."""
    order = _LINE_VERSION.split(", ")
    cells = table(spark, sf_dir, "lineitem").select(
        F.expr(_LINE_KEY.format("STRING")).alias("row_key"), F.lit("line").alias("family"),
        F.col("l_linestatus").alias("qualifier"), F.col("l_partkey").cast("string").cast("binary").alias("value"), *order)
    specs = [ColumnSpec("line", "O", "bigint", "open_part"), ColumnSpec("line", "F", "bigint", "filled_part")]
    return assemble_keyed(_keyed(spark, cells, 8), specs, order=order)


_EVENTS_BY_TYPE = """
newest AS (
  SELECT event_type, user_id, max(row(ts, event_id)) AS version, arg_max(value, row(ts, event_id)) AS value
  FROM events GROUP BY event_type, user_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY version) - 1 AS place FROM newest)"""


@query("read_row_pieces", f"""
WITH {_EVENTS_BY_TYPE}
SELECT event_type AS row_key, place // 40 AS piece, CAST(place % 40 AS INTEGER) AS place,
       CAST(user_id AS VARCHAR) AS qualifier, CAST(value AS VARCHAR) AS value FROM placed""")
def row_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows hold all cells, a qualifier per user, in pieces of 40 cells."""
    cells = event_cells(spark, sf_dir).select(
        F.col("qualifier").alias("row_key"), "family", F.col("row_key").alias("qualifier"), "value", "ts", "seq")
    pieces = read_row_pieces(cells, 40)
    return pieces.select("row_key", "piece", F.posexplode("cells").alias("place", "cell")).select(
        "row_key", "piece", "place", "cell.qualifier", F.col("cell.value").cast("string").alias("value"))


@query("assemble_from_pieces", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, {', '.join(_latest(k, 'CAST({} AS VARCHAR)') for k in EVENT_TYPES)}
FROM events GROUP BY user_id""")
def assemble_row_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_from_pieces(read_row_pieces(event_cells(spark, sf_dir), 2), {k.upper(): k for k in EVENT_TYPES})


@query("numbered_rows", """
SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS place
FROM orders""")
def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within three groups that hold all rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    return scan(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], number="place").drop("o_orderdate")


_PART_PAIRS = " UNION ALL ".join(
    f"SELECT CAST(p_partkey AS VARCHAR) AS row_key, '{f}' AS family, '{c}' AS qualifier, "
    f"CAST({c} AS VARCHAR) AS value FROM part" for c, f in PART_FAMILIES.items())


@query("dump_pairs", f"SELECT row_key, qualifier, value FROM ({_PART_PAIRS})")
def dump_cell_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_pairs(part_cells(spark, sf_dir))


@query("cell_pairs", f"SELECT row_key, qualifier, value FROM ({_PART_PAIRS})")
def cell_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cells_to_pairs(part_cells(spark, sf_dir))
    return pairs.withColumn("value", F.col("value").cast("string"))


@query("show_cells_range", f"""
SELECT row_key, family, qualifier, family || ':' || qualifier AS name, value,
       CASE WHEN row_key < '3' THEN 'low' WHEN row_key < '6' THEN 'middle' ELSE 'high' END AS part
FROM ({_PART_PAIRS})""")
def show_cells_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = part_cells(spark, sf_dir)
    ranges = {"low": (None, "3"), "middle": ("3", "6"), "high": ("6", None)}
    parts = [show_cells(key_range(cells, lo, hi)).withColumn("part", F.lit(name))
             for name, (lo, hi) in ranges.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("map_columns", f"""
SELECT row_key, qualifier AS target, value FROM ({_PART_PAIRS}) WHERE qualifier IN ('p_name', 'p_size')
UNION ALL SELECT row_key, 'size_again', value FROM ({_PART_PAIRS}) WHERE qualifier = 'p_size'""")
def map_cell_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _part_specs(p_name="string", p_size="int")
    specs.append(ColumnSpec("detail", "p_size", "int", "size_again"))
    specs.append(ColumnSpec("base", "p_type", "string", "wrong_family"))
    mapped = map_columns(part_cells(spark, sf_dir), specs)
    return mapped.select("row_key", "target", F.col("value").cast("string").alias("value"))


def _seen(kind: str, value: str, by: str, order: str) -> str:
    return (f"CAST(last_value(CASE WHEN {kind} THEN {value} END IGNORE NULLS) OVER "
            f"(PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS VARCHAR)")


@query("running_row", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key, event_id AS seq,
       {_seen("event_type = 'click'", 'value', 'user_id', 'ts, event_id')} AS click,
       {_seen("event_type = 'purchase'", 'value', 'user_id', 'ts, event_id')} AS purchase
FROM events""")
def running_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = event_cells(spark, sf_dir).withColumn("value", F.col("value").cast("string"))
    return running_row(cells, {"Click": "click", "Purchase": "purchase"}).select(
        "row_key", "seq", "click", "purchase")


@query("running_row_large_groups", f"""
SELECT l_returnflag AS row_key, l_orderkey, l_linenumber, l_partkey,
       {_seen("l_linestatus = 'O'", 'l_partkey', 'l_returnflag', 'l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice')} AS open_part,
       {_seen("l_linestatus = 'F'", 'l_partkey', 'l_returnflag', 'l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice')} AS filled_part
FROM lineitem""")
def running_rows_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups hold all rows, so each is scanned in several chunks."""
    cells = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("row_key"), F.col("l_linestatus").alias("qualifier"),
        F.col("l_partkey").cast("string").alias("value"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = running_row(cells, {"O": "open_part", "F": "filled_part"}, order=order)
    return rows.select("row_key", "l_orderkey", "l_linenumber", "l_partkey", "open_part", "filled_part")


@query("word_count", r"""
WITH lines AS (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM documents),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS n FROM words GROUP BY word""")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\r\n|\r|\n")).alias("value"))
    return word_count(lines)


@query("last_per_key", """
SELECT o_custkey, arg_max(o_orderkey, row(o_orderdate, o_orderkey)) AS o_orderkey,
       arg_max(o_orderpriority, row(o_orderdate, o_orderkey)) AS o_orderpriority
FROM orders GROUP BY o_custkey""")
def last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return last_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
