"""Tables by row key, rows in pieces and lists of sides."""

import random

import pytest
from pyspark.sql import functions as F

from cellframe import (
    KEY_ORDER, ColumnSpec, assemble, assemble_from_pieces, assemble_from_rows, assemble_keyed, collect_sides,
    read_keyed_cells, read_row_pieces, read_rows, session_settings, write_keyed_cells)

from helpers import cells_frame, rows

SPECS = [ColumnSpec("f", "a", "int", "x"), ColumnSpec("f", "b", "string", "y")]


def _cells(seed, hot):
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randrange(60)}", rng.choice("abc"), str(rng.randrange(100)), rng.randrange(5), n)
            for n in range(900)]


@pytest.fixture
def keyed(spark, tmp_path, request):
    name = f"keyed_{abs(hash(request.node.name))}"

    def written(cells, **options):
        write_keyed_cells(cells, name, str(tmp_path), 4, **options)
        return read_keyed_cells(spark, name)

    yield written
    for table in (name, f"{name}_large"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("wide", [False, True])
def test_keyed_rows_equal_assembled_ones(spark, keyed, wide):
    cells = cells_frame(spark, _cells(1, 0.4))
    table = keyed(cells)
    assert {r[0] for r in table.large.select("row_key").distinct().collect()} == {"hot"}
    assert table.cells.count() + table.large.count() == 900
    assert rows(assemble_keyed(table, SPECS, wide=wide)) == rows(assemble(cells, SPECS, wide=wide))


@pytest.mark.parametrize("wide", [False, True])
def test_keyed_cells_are_assembled_without_a_shuffle(spark, plan, keyed, wide, tmp_path):
    table = keyed(cells_frame(spark, _cells(2, 0)), bucket_rows=1000)
    assert table.large is None and len(list((tmp_path / "keyed").glob("*.parquet"))) == 4
    built = assemble_keyed(table, SPECS, wide=wide)
    assert "Exchange hashpartitioning" not in plan(built, executed=True)
    text = plan(built)
    assert "Bucketed: true" in text
    with session_settings(spark, KEY_ORDER):
        ordered = assemble_keyed(table, SPECS, wide=False)
        assert "Sort [" not in plan(ordered) and rows(ordered) == rows(built)


def test_only_large_keys_are_shuffled(spark, plan, keyed):
    text = plan(assemble_keyed(keyed(cells_frame(spark, _cells(3, 0.4))), SPECS))
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


def test_keyed_tables_are_replaced(spark, keyed):
    keyed(cells_frame(spark, _cells(4, 0.4)))
    assert rows(assemble_keyed(keyed(cells_frame(spark, [("1", "a", "5", 0, 0), (None, "a", "6", 0, 1)])), SPECS)) == [
        ("1", 5, None), (None, 6, None)]


def test_pieces_follow_each_other_as_one_list(spark):
    cells = cells_frame(spark, _cells(5, 0.4))
    pieces = read_row_pieces(cells, 2, chunks=7).collect()
    assert max(len(p.cells) for p in pieces) == 2
    whole = {r.row_key: r.cells for r in read_rows(cells).collect()}
    joined = {}
    for p in sorted(pieces, key=lambda p: (p.row_key, p.piece)):
        assert p.piece == len(joined.setdefault(p.row_key, [])) // 2
        joined[p.row_key] += p.cells
    assert joined == whole
    names = {"A": "x", "b": "y"}
    built = assemble_from_pieces(read_row_pieces(cells, 1), names)
    assert rows(built) == rows(assemble_from_rows(read_rows(cells), names))


def test_one_row_of_many_cells_spreads_over_tasks(spark):
    cells = spark.range(30_000).select(
        F.lit("r").alias("row_key"), F.lit("f").alias("family"), F.col("id").cast("string").alias("qualifier"),
        F.col("id").cast("string").cast("binary").alias("value"), F.lit(0).cast("bigint").alias("ts"), F.col("id").alias("seq"))
    pieces = read_row_pieces(cells, 1000, chunks=8)
    with session_settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = pieces.select("piece", F.size("cells").alias("n"), F.spark_partition_id().alias("task"), F.col("cells")[0]["seq"].alias("first")).collect()
    assert sorted((p.piece, p.n, p.first) for p in found) == [(k, 1000, 1000 * k) for k in range(30)]
    assert len({p.task for p in found}) > 1
    assert rows(assemble_from_pieces(pieces, {"29999": "x", "absent": "y"})) == [("r", "29999", None)]


def test_sides_of_a_large_key_are_bounded_lists(spark):
    df = spark.range(100_000).select(
        F.expr("CAST(if(id >= 0, 7, NULL) AS INT)").alias("key"), F.expr("if(id % 4 = 0, 'l', if(id >= 0, 'r', NULL))").alias("side"), F.expr("if(id >= 0, id, NULL)").alias("id"), F.col("id").cast("string").alias("text"))
    more = df.unionByName(spark.createDataFrame([(None, "l", 1, None), (None, "l", 1, None)], "key int, side string, id long, text string"))
    lists = collect_sides(more, ["key"], "side", ["id"], list_size=500, chunks=8)
    found = lists.select("key", "side", "part", F.size("records").alias("n"), F.col("records")[0].alias("first")).collect()
    left = sorted((p.part, p.n, p.first.id) for p in found if p.key == 7 and p.side == "l")
    assert left == [(k, 500, 2000 * k) for k in range(50)]
    assert sum(p.n for p in found if p.key == 7 and p.side == "r") == 75_000
    assert [(p.part, p.n, p.first.text) for p in found if p.key is None] == [(0, 2, None)]
