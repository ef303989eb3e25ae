
import pytest
from pyspark.sql import functions as F

from cellframe import compact, read_cells, read_lines, read_orc, read_sequence, session_settings, tag_source
from cellframe.plans import jobs
from cellframe.scratch import scratch_dir
from cellframe.session import packed_scans
from cellframe.sinks.files import write_orc, write_partition, write_sequence, write_tsv
from cellframe.sources.cells import unpivot_to_cells

from helpers import cells_frame, rows

CELLS = [("2", "b", "y", 0, 0), ("1", "a", "x", 0, 1), ("10", "a", "z", 0, 2), ("1", "b", "w", 0, 3)]


def _lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_tsv_nulls_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "tsv")
    df = spark.createDataFrame([("k", None, 1), (None, "v", 2)], "a string, b string, c int")
    for _ in range(2):
        write_tsv(df, path)
    assert _lines(spark, path) == ["k\t\t1", "v\t2"]


def test_fixed_number_of_files(spark, tmp_path):
    write_orc(spark.range(1000, numPartitions=7), str(tmp_path / "orc"), num_files=3)
    assert len(list((tmp_path / "orc").glob("*.orc"))) == 3


def test_sequence_files_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "seq")
    for values in (["a\tb", "c"], ["é\tx", ""]):
        write_sequence(spark.createDataFrame([(v,) for v in values], "line string"), path)
    assert sorted(r.value for r in read_sequence(spark, path).collect()) == ["", "é\tx"]


def test_partition_labels_stay_text(spark, tmp_path):
    root = str(tmp_path)
    for label, n in (("20180929082833123", 3), ("20180930000000000", 5)):
        write_partition(spark.range(n).withColumn("dt", F.lit("other")), root, "t", "dt", label)
    df = read_orc(spark, f"{root}/t", partition="dt", label="20180929082833123")
    assert dict(df.dtypes)["dt"] == "string"
    assert {r.dt for r in df.collect()} == {"20180929082833123"} and df.count() == 3
    assert read_orc(spark, f"{root}/t", partition="dt").count() == 8
    assert read_orc(spark, f"{root}/t/dt=20180930000000000").columns == ["id"]


def test_one_partition_is_opened(spark, plan, tmp_path):
    for label in ("1", "2"):
        write_partition(spark.range(3), str(tmp_path), "t", "dt", label)
    text = plan(read_orc(spark, str(tmp_path / "t"), partition="dt", label="1"))
    assert "InMemoryFileIndex(1 paths)" in text


def test_line_positions_follow_the_file(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(f"{i:06d}" for i in range(20_000)))
    with session_settings(spark, {"spark.sql.files.maxPartitionBytes": "16384"}):
        lines = read_lines(spark, str(path), position=True)
        assert lines.rdd.getNumPartitions() > 4
        values = [r.value for r in lines.orderBy("position").collect()]
    assert values == sorted(values) and len(values) == 20_000


def test_tags_by_path(spark, tmp_path):
    for name in ("studentinfo", "studentscore", "other"):
        (tmp_path / f"{name}.txt").write_text(name)
    lines = read_lines(spark, [str(tmp_path / f"{n}.txt") for n in ("studentinfo", "studentscore", "other")])
    got = rows(tag_source(lines, {"studentinfo": "info", "studentscore": "score"}))
    assert got == [("other", None), ("studentinfo", "info"), ("studentscore", "score")]


def test_small_files_are_packed_and_compacted(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(400).repartition(200).write.parquet(source)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with packed_scans(spark, 64 << 20):
        assert spark.read.parquet(source).rdd.getNumPartitions() == 1
    compact(spark, source, target)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1
    assert spark.read.parquet(target).count() == 400
    with pytest.raises(ValueError):
        compact(spark, source, source + "/")


def test_nested_directories_and_hidden_files(spark, tmp_path):
    cells_frame(spark, CELLS, 1).write.parquet(str(tmp_path / "top" / "inner"))
    cells_frame(spark, CELLS, 1).write.parquet(str(tmp_path / "top" / "_hidden"))
    assert read_cells(spark, str(tmp_path / "top"), recursive=True).count() == 4
    cells_frame(spark, CELLS, 1).write.orc(str(tmp_path / "orc"))
    assert rows(read_cells(spark, [str(tmp_path / "orc")], "orc").select("row_key")) == [("1",), ("1",), ("10",), ("2",)]


def test_unpivot_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 2.5)], "k int, a string, b double")
    cells = unpivot_to_cells(df, "k", {"a": "f", "b": "g"}, ["a", "b"], ts=F.lit(7))
    assert rows(cells.selectExpr("row_key", "family", "qualifier", "cast(value as string)", "ts", "seq")) == [
        ("1", "f", "a", "x", 7, 0), ("2", "g", "b", "2.5", 7, 0)]


def test_cell_jobs(spark, tmp_path):
    cells = cells_frame(spark, CELLS)
    out = str(tmp_path / "out")
    jobs.cells_to_orc(cells, {"A": "x", "b": "y"}, "x", out, num_files=1)
    assert rows(spark.read.orc(out)) == [("x", "w"), ("z", None)]
    jobs.cells_to_sequence(cells, "a", "b", str(tmp_path / "seq"))
    assert sorted(r.value for r in read_sequence(spark, str(tmp_path / "seq")).collect()) == ["x\tw", "z\t"]
    jobs.cells_to_text(cells, str(tmp_path / "text"), num_files=1)
    assert [r.value for r in spark.read.text(str(tmp_path / "text")).collect()][-1] == "b\ty"
    jobs.running_rows_to_orc(cells, {"a": "x", "b": "y"}, str(tmp_path / "running"))
    assert rows(spark.read.orc(str(tmp_path / "running"))) == [
        ("x", "w"), ("x", None), ("z", None), (None, "y")]
    grouped = cells.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("ts", "seq", "qualifier", "value"))).alias("cells"))
    jobs.rows_to_orc(grouped, {"a": "x"}, str(tmp_path / "rows"))
    assert rows(spark.read.orc(str(tmp_path / "rows"))) == [("x",), ("z",), (None,)]


def test_word_count_job(spark, tmp_path):
    (tmp_path / "in.txt").write_text("b a\nb\n")
    jobs.count_words(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    assert _lines(spark, str(tmp_path / "out")) == ["a\t1", "b\t2"]


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{root}/cellframe/x-") and first != second


def test_partition_has_its_own_columns(spark, plan, tmp_path):
    table = str(tmp_path / "t")
    spark.createDataFrame([("x", 1)], "k string, b int").write.orc(f"{table}/dt=1")
    spark.createDataFrame([("y", "z", 2)], "k string, a string, b int").write.orc(f"{table}/dt=2")
    first, second = (read_orc(spark, table, partition="dt", label=n) for n in ("1", "2"))
    assert first.columns == ["k", "b", "dt"] and rows(first) == [("x", 1, "1")]
    assert second.columns == ["k", "a", "b", "dt"] and rows(second) == [("y", "z", 2, "2")]
    assert "dt=2" not in plan(first)


def test_failed_partition_keeps_the_old_rows(spark, tmp_path):
    good = spark.createDataFrame([("x", 1)], "k string, b int")
    path = write_partition(good, str(tmp_path), "t", "dt", "1")
    with pytest.raises(Exception, match="lost"):
        write_partition(good.withColumn("b", F.raise_error(F.lit("lost")).cast("int")), str(tmp_path), "t", "dt", "1")
    assert rows(spark.read.orc(path)) == [("x", 1)]
    write_partition(good.withColumn("b", F.lit(2)), str(tmp_path), "t", "dt", "1")
    assert rows(read_orc(spark, str(tmp_path / "t"), partition="dt", label="1")) == [("x", 2, "1")]
