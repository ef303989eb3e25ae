import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellframe import MANIFEST, ColumnSpec, ExportSpec, export
from cellframe.plans import jobs
from cellframe.plans.manifest import (
    freeze, freeze_files, latest_snapshot, latest_snapshots, read_manifest, read_snapshot, snapshot_files)
from cellframe.sinks.tables import create_table_sql, table_name

from helpers import cells_frame, rows

CELLS = [("1", "a", "5", 0, 0), ("1", "b", "x", 0, 1), ("2", "a", "6", 0, 2), ("2", "a", "7", 1, 0)]
SPEC = ExportSpec("ns:Item", "Item_Base", (ColumnSpec("f", "a", "int", "A"), ColumnSpec("f", "b", "string", "B")), num_files=2)


def _manifest(spark, entries):
    day = datetime.datetime(2020, 1, 1)
    data = [(s, t, day + datetime.timedelta(days=d), f, live, old) for s, t, d, f, live, old in entries]
    return spark.createDataFrame(data, MANIFEST)


def test_latest_snapshot_needs_the_whole_table_name(spark):
    manifest = _manifest(spark, [
        ("SNP_TS_ns_Item_1", "ns:Item", 1, "f", "p", None), ("SNP_TS_ns_Item_2", "ns:Item", 2, "f", "p", None),
        ("SNP_TS_ns_ItemBase_3", "ns:ItemBase", 3, "f", "p", None), ("other_ns_Item_4", "ns:Item", 4, "f", "p", None),
        ("SNP_TS_ns_Item_0", "ns:Item", 2, "f", "p", None)])
    assert latest_snapshot(manifest, "ns:Item").first().snapshot == "SNP_TS_ns_Item_2"
    assert latest_snapshots(manifest).count() == 2
    assert latest_snapshot(manifest, "ns:It").first() is None


def test_file_paths_fall_back_to_the_archive(spark):
    manifest = _manifest(spark, [
        ("s", "t", 0, "f", "t=r=file", "arch1"), ("s", "t", 0, "f", "t=r=l=file", "arch2"),
        ("s", "t", 0, "f", None, "arch3"), ("s", "t", 0, "f", "a=b=c=d", None), ("s", "t", 0, "g", "live", None),
        ("r", "t", 0, "f", "live", None)])
    assert rows(snapshot_files(manifest, "s", ["f"]).select("path")) == [("arch2",), ("arch3",), ("t=r=file",)]
    assert snapshot_files(manifest, "s").count() == 4


def test_frozen_copy_is_replaced_and_pruned(spark, plan, tmp_path):
    root = str(tmp_path)
    cells = cells_frame(spark, CELLS)
    both = cells.unionByName(cells.withColumn("family", F.lit("g")))
    for part in (both.limit(0), both):
        name = freeze(part, root, "ns:Item", "001", ["f", "g"], grace=0)
    assert name == "SNP_TS_ns_Item_001"
    manifest = read_manifest(spark, root)
    assert {r.family for r in manifest.collect()} == {"f", "g"}
    assert "PartitionFilters: [isnotnull(snapshot" in plan(snapshot_files(manifest, name))
    assert len(list((tmp_path / "data" / name).iterdir())) == 1
    freeze(both, root, "ns:Item", "002", ["f"])
    assert {r.snapshot for r in read_manifest(spark, root).collect()} == {name, name.replace("001", "002")}
    assert read_snapshot(spark, manifest, name).count() == 8
    only = read_snapshot(spark, manifest, name, ["f"])
    assert {r.family for r in only.collect()} == {"f"} and only.count() == 4
    assert read_snapshot(spark, manifest, name, ["h"]).count() == 0
    with pytest.raises(ValueError):
        read_snapshot(spark, manifest, "other", ["f"])


def test_listed_files_do_not_grow(spark, tmp_path):
    source, root = str(tmp_path / "cells"), str(tmp_path / "root")
    cells_frame(spark, CELLS).write.partitionBy("family").parquet(source)
    name = freeze_files(spark, source, root, "ns:Item", "001")
    cells_frame(spark, CELLS).write.mode("append").partitionBy("family").parquet(source)
    got = read_snapshot(spark, read_manifest(spark, root), name, ["f"])
    assert got.count() == 4 and {r.family for r in got.collect()} == {"f"}
    assert jobs.latest_cells(spark, root, "ns:Item", ["f"]).count() == 4
    with pytest.raises(ValueError):
        jobs.latest_cells(spark, root, "ns:Other", ["f"])


def test_export_publishes_dated_partitions(spark, tmp_path):
    root = str(tmp_path)
    cells = cells_frame(spark, CELLS)
    newer = cells.where("ts = 0")
    args = dict(table_prefix="pre_", grace=0)
    assert export(spark, [SPEC], {"ns:Item": cells}, root, "001", **args) == ["pre_item_base"]
    export(spark, [SPEC], {"ns:Item": newer}, root, "002", **args)
    export(spark, [SPEC], {"ns:Item": newer}, root, "002", **args)
    table = spark.table("pre_item_base")
    assert dict(table.dtypes) == {"A": "int", "B": "string", "dt": "string"}
    assert rows(table) == [(5, "x", "001"), (5, "x", "002"), (6, None, "002"), (7, None, "001")]
    assert len(list((tmp_path / "tables" / "pre_item_base" / "dt=001").glob("*/*.orc"))) == 2
    assert len(list((tmp_path / "tables" / "pre_item_base" / "dt=002").iterdir())) == 1


def test_failed_export_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)
    export(spark, [SPEC], {"ns:Item": cells_frame(spark, CELLS)}, root, "001", table_prefix="bad_")
    broken = cells_frame(spark, [("1", "a", "x", 0, 0)])
    with pytest.raises(PySparkException):
        export(spark, [SPEC], {"ns:Item": broken}, root, "002", table_prefix="bad_")
    assert {r.dt for r in spark.table("bad_item_base").collect()} == {"001"}


def test_failed_export_of_a_published_label_keeps_its_rows(spark, tmp_path):
    root = str(tmp_path)
    export(spark, [SPEC], {"ns:Item": cells_frame(spark, CELLS)}, root, "001", table_prefix="kept_")
    before = rows(spark.table("kept_item_base"))
    with pytest.raises(PySparkException):
        export(spark, [SPEC], {"ns:Item": cells_frame(spark, [("1", "a", "x", 0, 0)])}, root, "001", table_prefix="kept_")
    assert len(before) == 2 and rows(spark.table("kept_item_base")) == before


def test_failed_freeze_keeps_the_snapshot(spark, tmp_path):
    root = str(tmp_path)
    name = freeze(cells_frame(spark, CELLS), root, "ns:Item", "001", ["f"])
    broken = cells_frame(spark, CELLS).withColumn("ts", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(PySparkException):
        freeze(broken, root, "ns:Item", "001", ["f"])
    assert read_snapshot(spark, read_manifest(spark, root), name).count() == 4


def test_family_without_cells_gives_null_columns(spark, tmp_path):
    spec = ExportSpec("ns:Item", "Empty_Family", (ColumnSpec("f", "a", "int", "A"), ColumnSpec("g", "b", "string", "B")))
    export(spark, [spec], {"ns:Item": cells_frame(spark, CELLS)}, str(tmp_path), "001")
    assert rows(spark.table("empty_family")) == [(5, None, "001"), (7, None, "001")]
    export(spark, [spec], {"ns:Item": cells_frame(spark, CELLS).where("false")}, str(tmp_path), "001")
    assert spark.table("empty_family").count() == 0


def test_snapshot_half_live_half_archived(spark, tmp_path):
    live, archive, root = tmp_path / "live", tmp_path / "archive", str(tmp_path / "root")
    cells_frame(spark, CELLS).write.partitionBy("family").parquet(str(live))
    name = freeze_files(spark, str(live), root, "ns:Item", "001")
    files = sorted((live / "family=f").glob("*.parquet"))
    assert len(files) > 1
    (archive / "family=f").mkdir(parents=True)
    files[0].rename(archive / "family=f" / files[0].name)
    cells_frame(spark, [("9", "a", "9", 0, 0)]).drop("family").write.mode("append").parquet(str(archive / "family=f"))
    manifest = read_manifest(spark, root)
    moved = manifest.withColumn("archive_path", F.replace("live_path", F.lit(str(live)), F.lit(str(archive))))
    assert rows(read_snapshot(spark, moved, name).select("row_key", "qualifier", "ts")) == [
        ("1", "a", 0), ("1", "b", 0), ("2", "a", 0), ("2", "a", 1)]
    some = read_snapshot(spark, manifest, name).count()
    assert 0 < some < 4
    assert len(list((tmp_path / "root" / "manifest").rglob("*.parquet"))) == 1


def test_table_statement():
    sql = create_table_sql(SPEC, "/data/it's", "dt", "Pre_")
    assert sql == ("CREATE TABLE IF NOT EXISTS `pre_item_base` (`A` int, `B` string, `dt` string) "
                   "USING ORC PARTITIONED BY (`dt`) LOCATION '/data/it\\'s'")
    assert table_name("Item", "X_") == "x_item"
