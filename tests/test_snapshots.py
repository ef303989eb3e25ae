"""Commits of writers at the same time, replaced directories, ranges of keys, rejecting exports."""

import threading

import pytest
from pyspark.sql import functions as F

from cellframe import ColumnSpec, ExportSpec, assemble, export, export_reports
from cellframe.plans.commits import clean_up, commit, committed, retire
from cellframe.plans.manifest import freeze, freeze_files, read_manifest, read_snapshot
from cellframe.scratch import replace_dir

from helpers import cells_frame, rows

CELLS = [("1", "a", "5", 0, 0), ("1", "b", "x", 0, 1), ("2", "a", "6", 0, 2), ("2", "a", "7", 1, 0)]


def _together(*jobs):
    """Run functions in threads; what they raise is raised here."""
    failed, threads = [], []

    def run(job):
        try:
            job()
        except Exception as error:
            failed.append(error)

    for job in jobs:
        threads.append(threading.Thread(target=run, args=(job,)))
        threads[-1].start()
    for thread in threads:
        thread.join()
    if failed:
        raise failed[0]


def test_commits_of_many_writers_are_all_kept(spark, tmp_path):
    log, numbers = str(tmp_path / "log"), []
    _together(*[lambda k=k: numbers.extend(commit(spark, log, f"{k}-{i}") for i in range(8)) for k in range(6)])
    assert sorted(numbers) == list(range(1, 49))
    lines = committed(spark, log)
    assert sorted(lines) == sorted(f"{k}-{i}" for k in range(6) for i in range(8))
    for k in range(6):
        assert [x for x in lines if x.startswith(f"{k}-")] == [f"{k}-{i}" for i in range(8)]


def test_two_freezes_of_one_name_leave_one_whole_snapshot(spark, tmp_path):
    root = str(tmp_path)
    frames = [cells_frame(spark, [(str(k), "a", f"{writer}", 0, k) for k in range(50 + writer)], 4) for writer in range(3)]
    _together(*[lambda f=f: freeze(f, root, "ns:Item", "001", ["f"]) for f in frames])
    found = read_snapshot(spark, read_manifest(spark, root), "SNP_TS_ns_Item_001")
    values = {bytes(r.value) for r in found.collect()}
    assert len(values) == 1 and found.count() == 50 + int(values.pop())
    clean_up(spark, root, 0)
    assert len(list((tmp_path / "data" / "SNP_TS_ns_Item_001").iterdir())) == 1
    assert read_snapshot(spark, read_manifest(spark, root), "SNP_TS_ns_Item_001").count() == found.count()


def test_replaced_directories_stay_for_their_time(spark, tmp_path):
    old = tmp_path / "old"
    old.mkdir()
    retire(spark, str(tmp_path), [str(old)])
    assert clean_up(spark, str(tmp_path)) == [] and old.exists()
    assert clean_up(spark, str(tmp_path), 0) == [str(old)] and not old.exists()
    assert clean_up(spark, str(tmp_path), 0) == []


def test_queries_planned_before_a_new_export_still_end(spark, tmp_path):
    spec = ExportSpec("ns:Item", "Planned", (ColumnSpec("f", "a", "int", "A"), ColumnSpec("f", "b", "string", "B")))
    root, cells = str(tmp_path), cells_frame(spark, CELLS)
    export(spark, [spec], {"ns:Item": cells}, root, "001")
    before = spark.table("planned").where("dt = '001'")
    listed = before._jdf.queryExecution().executedPlan().toString()  # files are listed here
    name = "SNP_TS_ns_Item_001"
    frozen = read_snapshot(spark, read_manifest(spark, root), name)
    assert "planned" in listed
    export(spark, [spec], {"ns:Item": cells.where("ts = 0")}, root, "001")
    assert rows(before) == [(5, "x", "001"), (7, None, "001")]
    assert frozen.count() == 4
    assert rows(spark.table("planned")) == [(5, "x", "001"), (6, None, "001")]
    clean_up(spark, root, 0)
    assert rows(spark.table("planned")) == [(5, "x", "001"), (6, None, "001")]
    assert len(list((tmp_path / "tables" / "planned" / "dt=001").iterdir())) == 1


def test_a_refused_rename_is_an_error(spark, tmp_path, monkeypatch):
    from cellframe import scratch
    (tmp_path / "fresh").mkdir()
    (tmp_path / "there").mkdir()
    real = scratch._file_system

    class Refusing:
        def __init__(self, system):
            self.system = system

        def rename(self, *_):
            return False

        def __getattr__(self, name):
            return getattr(self.system, name)

    monkeypatch.setattr(scratch, "_file_system", lambda s, p: (Refusing(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError):
        replace_dir(spark, str(tmp_path / "fresh"), str(tmp_path / "there"))
    assert list((tmp_path / "there").iterdir()) == []


def _keys(frame):
    return sorted({r.row_key for r in frame.collect()})


def test_a_range_of_keys_opens_its_files_only(spark, tmp_path):
    root = str(tmp_path)
    cells = cells_frame(spark, [(f"k{k:03d}", q, "v", 0, k) for k in range(200) for q in "ab"], 5)
    both = cells.unionByName(cells.withColumn("family", F.lit("g")))
    name = freeze(both, root, "ns:Item", "001", ["f", "g"], key_files=10)
    manifest = read_manifest(spark, root)
    assert manifest.where("low_key IS NULL").count() == 0
    whole = read_snapshot(spark, manifest, name)
    some = read_snapshot(spark, manifest, name, ["f"], lo="k050", hi="k060")
    assert _keys(some) == [f"k{k:03d}" for k in range(50, 60)] and some.count() == 20
    assert 1 <= len(some.inputFiles()) <= 2 < len(whole.inputFiles())
    assert _keys(read_snapshot(spark, manifest, name, lo="k190")) == [f"k{k:03d}" for k in range(190, 200)]
    assert read_snapshot(spark, manifest, name, hi="a").count() == 0


def test_ranges_of_files_without_known_keys(spark, tmp_path):
    source, root = str(tmp_path / "cells"), str(tmp_path / "root")
    cells_frame(spark, CELLS).write.partitionBy("family").parquet(source)
    name = freeze_files(spark, source, root, "ns:Item", "001")
    assert _keys(read_snapshot(spark, read_manifest(spark, root), name, lo="2")) == ["2"]


@pytest.mark.parametrize("scan_files", [2, 10_000])
def test_stray_files_cost_no_shuffle_of_cells(spark, plan, tmp_path, monkeypatch, scan_files):
    """Files chosen by a job, and by listing their few directories."""
    from cellframe.plans import manifest as module
    monkeypatch.setattr(module, "SCAN_FILES", scan_files)
    source, root = str(tmp_path / "cells"), str(tmp_path / "root")
    cells_frame(spark, CELLS * 3, 5).write.partitionBy("family").parquet(source)
    name = freeze_files(spark, source, root, "ns:Item", "001")
    before = read_snapshot(spark, read_manifest(spark, root), name)
    assert "Join" not in plan(before) and "Exchange" not in plan(before)
    cells_frame(spark, CELLS).write.mode("append").partitionBy("family").parquet(source)
    after = read_snapshot(spark, read_manifest(spark, root), name)
    assert "Join" not in plan(after) and "Exchange" not in plan(after)
    assert rows(after.drop("value")) == rows(before.drop("value")) and after.count() == 12


SPEC = ExportSpec("ns:Item", "Checked", (ColumnSpec("f", "a", "int", "A"), ColumnSpec("f", "b", "string", "B"), ColumnSpec("f", "a", "tinyint", "C")))


def test_rejecting_exports_separate_rows_and_count_them(spark, tmp_path):
    broken = cells_frame(spark, [*CELLS, ("3", "a", "x", 0, 0), ("4", "a", "300", 0, 0), ("4", "b", "y", 0, 1)])
    report, = export_reports(spark, [SPEC], {"ns:Item": broken}, str(tmp_path), "001", on_error="reject")
    assert (report.rows, report.rejected_rows, report.rejected) == (2, 2, {"A": 1, "C": 1})
    assert rows(spark.table("checked").select("A", "B", "dt")) == [(5, "x", "001"), (7, None, "001")]
    bad = spark.read.orc(report.rejects_path)
    assert sorted((r.row_key, r.A, r.B, [(x.column, bytes(x.value)) for x in r.rejects]) for r in bad.collect()) == [
        ("3", None, None, [("A", b"x")]), ("4", 300, "y", [("C", b"300")])]
    report, = export_reports(spark, [SPEC], {"ns:Item": broken.where("row_key = '3'")}, str(tmp_path), "001", on_error="reject", grace=0)
    assert (report.rows, report.rejected_rows) == (0, 1) and spark.table("checked").count() == 0
    report, = export_reports(spark, [SPEC], {"ns:Item": cells_frame(spark, CELLS)}, str(tmp_path), "001")
    assert (report.rows, report.rejected_rows, report.rejects_path) == (2, 0, None)


@pytest.mark.parametrize("wide", [False, True])
def test_rejected_values_of_both_forms(spark, wide):
    broken = cells_frame(spark, [*CELLS, ("3", "a", "x", 0, 0), ("4", "a", "300", 0, 0)])
    got = assemble(broken, SPEC.columns, on_error="reject", wide=wide)
    assert sorted((r.row_key, [(x.column, bytes(x.value)) for x in r.rejects]) for r in got.collect()) == [
        ("1", []), ("2", []), ("3", [("A", b"x")]), ("4", [("C", b"300")])]  # one byte is a tinyint
    text = broken.withColumn("value", F.col("value").cast("string"))
    again = assemble(text, SPEC.columns, on_error="reject", wide=wide)
    assert sorted((r.row_key, len(r.rejects)) for r in again.collect()) == [("1", 0), ("2", 0), ("3", 2), ("4", 1)]
