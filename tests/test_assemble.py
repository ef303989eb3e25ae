import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellframe import (
    ColumnSpec, ExportSpec, assemble, assemble_from_rows, assemble_strings, assemble_tsv, dump_pairs, read_rows,
    running_row, session_settings)
from cellframe.model import distinct_families, extend_schema, schema_of, schema_string
from cellframe.operators import ordered
from cellframe.operators.select import conform, drop_columns, drop_empty_rows, families, key_range, require_nonempty

from workload.registry import PART_FAMILIES, part_cells

from helpers import cells_frame, rows

SPECS = [ColumnSpec("f", "a", "int", "x"), ColumnSpec("f", "b", "string", "y")]


def _random_cells(seed, keys=20, cells=400):
    """A third of all cells belong to one key."""
    rng = random.Random(seed)
    out = []
    for seq in range(cells):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        out.append((key, rng.choice("abc"), str(rng.randrange(100)), rng.randrange(5), seq))
    rng.shuffle(out)
    return out


def _expected(cells):
    newest = {}
    for key, q, value, ts, seq in cells:
        if q in "ab" and (ts, seq) >= newest.get((key, q), ((-1, -1), None))[0]:
            newest[key, q] = ((ts, seq), value)
    table = {}
    for (key, q), (_, value) in newest.items():
        table.setdefault(key, {})[q] = value
    return sorted(((k, int(v["a"]) if "a" in v else None, v.get("b")) for k, v in table.items()), key=repr)


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_newest_version_wins_in_any_order(spark, seed, wide):
    cells = _random_cells(seed)
    assert rows(assemble(cells_frame(spark, cells, 1 + 4 * seed), SPECS, wide=wide)) == _expected(cells)


def test_missing_cells_are_null_not_stale(spark):
    cells = [("1", "a", "5", 0, 0), ("1", "b", "t", 0, 1), ("2", "a", "6", 0, 2), ("3", "b", "u", 0, 3), ("4", "c", "v", 0, 4)]
    assert rows(assemble(cells_frame(spark, cells, 1), SPECS)) == [("1", 5, "t"), ("2", 6, None), ("3", None, "u")]


def test_one_source_fills_two_targets(spark):
    specs = [*SPECS, ColumnSpec("f", "a", "string", "z")]
    cells = cells_frame(spark, [("1", "a", "5", 0, 0)])
    for wide in (False, True):
        assert rows(assemble(cells, specs, wide=wide)) == [("1", 5, None, "5")]


def test_undecodable_values(spark):
    cells = cells_frame(spark, [("1", "a", "x", 0, 0)])
    for wide in (False, True):
        with pytest.raises(PySparkException, match="cannot decode x as int"):
            assemble(cells, SPECS, wide=wide).collect()
        assert rows(assemble(cells, SPECS, on_error="null", wide=wide)) == [("1", None, None)]


def test_qualifiers_in_any_case_and_required(spark):
    cells = cells_frame(spark, [("1", "ItemNumber", "n1", 0, 0), ("1", "GROUP", "g", 0, 1), ("2", "group", "h", 0, 2)])
    names = {"itemnumber": "number", "Group": "group"}
    assert rows(assemble_strings(cells, names)) == [("1", "n1", "g"), ("2", None, "h")]
    assert rows(assemble_strings(cells, names, required="number")) == [("1", "n1", "g")]


def test_tsv_needs_a_key_text(spark):
    cells = cells_frame(spark, [
        ("1", "k", "n1", 0, 0), ("1", "v", "g", 0, 1), ("2", "k", "", 0, 2), ("3", "k", "n3", 0, 3), ("4", "v", "h", 0, 4)])
    assert rows(assemble_tsv(cells, "K", "V")) == [("n1\tg",), ("n3\t",)]


def test_rows_hold_the_newest_cells(spark):
    cells = _random_cells(3)
    grouped = read_rows(cells_frame(spark, cells), ["a", "b"])
    assert sum(len(r.cells) for r in read_rows(cells_frame(spark, cells)).collect()) == len({(k, q) for k, q, *_ in cells})
    assert max(len(r.cells) for r in grouped.collect()) <= 2
    got = rows(assemble_from_rows(drop_empty_rows(grouped), {"A": "x", "B": "y"}))
    assert got == sorted(((k, None if x is None else str(x), y) for k, x, y in _expected(cells)), key=repr)


def test_row_assembly_does_not_shuffle(spark, plan, tmp_path):
    read_rows(cells_frame(spark, _random_cells(3)), ["a", "b"]).write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert "Exchange" not in plan(assemble_from_rows(stored, {"a": "x"}))


def test_dump_is_ordered_inside_each_file(spark, plan, tmp_path):
    cells = _random_cells(4)
    dumped = dump_pairs(cells_frame(spark, cells), 4)
    assert plan(dumped, executed=True).split("== Initial Plan ==")[-1].count("Exchange rangepartitioning") == 1
    dumped.write.parquet(str(tmp_path / "dump"))
    files = list((tmp_path / "dump").glob("*.parquet"))
    everything = []
    holders = 0
    for f in files:
        part = [tuple(r) for r in spark.read.parquet(str(f)).collect()]
        assert [p[0] for p in part] == sorted(p[0] for p in part)
        holders += any(p[0] == "hot" for p in part)
        everything += part
    assert sorted(everything) == sorted((k, q, v) for k, q, v, _, _ in cells)
    assert holders > 1  # a third of all cells do not fit one of four files


def _running(cells):
    out, state = [], {}
    for key, q, value, ts, seq in sorted(cells, key=lambda c: (c[0], c[3], c[4])):
        seen = state.setdefault(key, {})
        seen[q] = value
        out.append((key, seq, seen.get("a"), seen.get("b")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunks", [None, 1, 3, 7, 50])
def test_running_rows_however_they_are_cut(spark, chunks):
    cells = _random_cells(7)
    text = cells_frame(spark, cells).selectExpr("row_key", "qualifier", "cast(value as string) value", "ts", "seq")
    got = running_row(text, {"A": "x", "b": "y"}, chunks=chunks)
    assert rows(got.select("row_key", "seq", "x", "y")) == _running(cells)


def test_running_rows_of_a_missing_key(spark):
    cells = [(None, "a", "1", 0, 0), (None, "b", "2", 0, 1), (None, "b", None, 0, 2), ("k", "b", "3", 0, 3)]
    got = running_row(cells_frame(spark, cells).withColumn("value", F.col("value").cast("string")), {"a": "x", "b": "y"}, chunks=3)
    assert rows(got.select("row_key", "seq", "x", "y")) == [("k", 3, None, "3"), (None, 0, "1", None), (None, 1, "1", "2"), (None, 2, "1", "2")]


def test_running_rows_move_the_data_once(spark, plan, tmp_path):
    path = str(tmp_path / "cells")
    cells_frame(spark, _random_cells(7)).write.parquet(path)
    text = plan(running_row(spark.read.parquet(path), {"a": "x"}, chunks=3), executed=True).split("== Initial Plan ==")[0]
    # Only the small rows between ranges are shuffled besides, and nothing is gathered.
    assert text.count("Exchange rangepartitioning(row_key") - text.count("ReusedExchange") <= 1
    assert "BroadcastHashJoin" in text and "collect_list" not in text and "SinglePartition" not in text
    assert not any("seq" in line for line in text.split("\n") if "Exchange hashpartitioning" in line)


def test_running_rows_do_not_rely_on_reused_exchanges(spark):
    cells = _random_cells(8)
    text = cells_frame(spark, cells).selectExpr("row_key", "qualifier", "cast(value as string) value", "ts", "seq")
    with session_settings(spark, {"spark.sql.exchange.reuse": "false"}):
        got = running_row(text, {"A": "x", "b": "y"}, chunks=5)
        assert rows(got.select("row_key", "seq", "x", "y")) == _running(cells)


@pytest.mark.parametrize("block, limit", [(1024, 4096), (2, 0), (3, 4096)])
def test_scans_number_rows_over_blocks_of_ranges(spark, monkeypatch, block, limit):
    monkeypatch.setattr(ordered, "BLOCK", block)
    monkeypatch.setattr(ordered, "BROADCAST_RANGES", limit)
    rng = random.Random(block)
    data = [(rng.choice((None, "hot", "hot", f"k{rng.randrange(40)}")), k, rng.choice((None, None, None, k))) for k in range(3000)]
    df = spark.createDataFrame(data, "g string, o long, v long").repartition(5)
    got = ordered.scan(df, ["g"], ["o"], fill=["v"], number="n", chunks=40)
    state, expected = {}, []
    for g, o, v in data:
        n, last = state.get(g, (0, None))
        state[g] = n + 1, last if v is None else v
        expected.append((g, o, state[g][1], n + 1))
    assert rows(got) == sorted(expected, key=repr)


def test_scans_of_odd_groups(spark):
    df = spark.createDataFrame([(float("nan"), 1, 5), (float("nan"), 2, None), (None, 1, None), (0.5, 1, None)], "g double, o int, v int")
    got = ordered.scan(df, ["g"], ["o"], fill=["v"], number="n", chunks=4)
    assert repr(rows(got)) == "[(0.5, 1, None, 1), (None, 1, None, 1), (nan, 1, 5, 1), (nan, 2, 5, 2)]"
    assert ordered.scan(df.where("false"), ["g"], ["o"], number="n").collect() == []


def test_assembly_combines_before_the_shuffle(spark, plan):
    text = plan(assemble(cells_frame(spark, _random_cells(1)), SPECS))
    assert "partial_max_by" in text and "BroadcastHashJoin" in text


def test_filters(spark):
    cells = cells_frame(spark, [("1", "a", "5", 0, 0), ("10", "b", "", 0, 1), ("2", "c", "7", 0, 2)])
    assert families(cells, "g,f").count() == 3 and families(cells, "g").count() == 0
    assert {r.row_key for r in key_range(cells, "10", "2").collect()} == {"10"}
    assert require_nonempty(cells.selectExpr("cast(value as string) v"), "v").count() == 2


def test_filters_reach_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "cells")
    cells_frame(spark, _random_cells(1)).write.partitionBy("family").parquet(path)
    from cellframe import read_cells
    text = plan(key_range(families(read_cells(spark, path), "f"), "k1", "k2"))
    assert "PartitionFilters: [isnotnull(family" in text or "PartitionFilters: [(family" in text
    assert "GreaterThanOrEqual(row_key,k1)" in text and "LessThan(row_key,k2)" in text


def test_schemas():
    specs = [ColumnSpec("f", "a", "INT", "A"), ColumnSpec("g", "b", "varchar(5)", "b"), ColumnSpec("f", "c", "date", "c")]
    assert distinct_families(specs) == ["f", "g"]
    assert schema_string(specs) == "struct<A:int,b:varchar(5),c:date>"
    assert extend_schema(schema_of(specs), "dt").simpleString() == "struct<A:int,b:varchar(5),c:date,dt:string>"
    with pytest.raises(ValueError):
        ExportSpec("s", "t", [specs[0], ColumnSpec("f", "x", "int", "a")])
    with pytest.raises(ValueError):
        ExportSpec("s", "t", [])


def test_conform_and_drop(spark):
    df = spark.createDataFrame([(1, "x", "d")], "a int, B string, DT string")
    assert drop_columns(df, "dt").columns == ["a", "B"]
    schema = extend_schema(schema_of([ColumnSpec("f", "b", "string", "b"), ColumnSpec("f", "n", "int", "n")]), "a")
    assert conform(df, schema).collect() == [("x", None, "1")]


def test_cells_of_small_files_are_spread_over_tasks(spark, tmp_path):
    id = F.col("id")
    spark.range(0, 150_000, 1, 1).select(id.alias("p_partkey"), *[F.lit("same").alias(n) for n in PART_FAMILIES]).write.parquet(
        str(tmp_path / "part.parquet"))
    cells = part_cells(spark, str(tmp_path), versions=3)
    sizes = [r["n"] for r in cells.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 150_000 * 15 and max(sizes) <= 1_000_000
