import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe import inner_join, last_per_key, side_counts, tagged_union
from cellframe.operators.joins import override_columns
from cellframe.operators.skew import hot_keys
from cellframe.plans import jobs

from helpers import rows

# The sample records, spelled as given.
INFO = "1\tfrank\ttrue\tstudent\n2\talan\tfalse\tteacher\n3\tbyran\ttrue\tteacher\n4\tfoster\tfalse\tstucent\n4\ttiny\tfalse\tsudent"
SCORE = "1\t80\n2\t90\n3\t40\n4\t20"

INFO_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("studentname", T.StringType()),
    T.StructField("isstu", T.StringType()), T.StructField("remark", T.StringType())])
SCORE_SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("score", T.IntegerType())])


def _write(tmp_path, info=INFO, score=SCORE):
    paths = tmp_path / "studentinfo.txt", tmp_path / "studentscore.txt"
    for path, text in zip(paths, (info, score)):
        path.write_text(text)
    return [str(p) for p in paths]


def _lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def _merge(spark, tmp_path, info=INFO, score=SCORE):
    out = str(tmp_path / "merged")
    jobs.merge_records(spark, *_write(tmp_path, info, score), INFO_SCHEMA, SCORE_SCHEMA,
                       "id", "studentname", "score", out)
    return _lines(spark, out)


def test_merge_of_the_sample_records(spark, tmp_path):
    assert _merge(spark, tmp_path) == [
        "1\tfrank_score_80\t80", "2\talan_score_90\t90", "3\tbyran_score_40\t40", "4\ttiny_score_20\t20"]


def test_merge_keeps_keys_of_one_side(spark, tmp_path):
    assert _merge(spark, tmp_path, score="1\t80\n9\t7") == [
        "1\tfrank_score_80\t80", "2\talan_info_0\t0", "3\tbyran_info_0\t0", "4\ttiny_info_0\t0", "9\t_score_7\t7"]


def test_merge_as_map_of_the_sample_records(spark, tmp_path):
    names = (["id", "studentname", "isstu", "remark"], ["id", "score"], ["id", "studentname", "score"])
    info, score = _write(tmp_path)
    jobs.merge_lines(spark, info, score, *names, str(tmp_path / "out"))
    assert _lines(spark, str(tmp_path / "out")) == ["1\tfrank\t80", "2\talan\t90", "3\tbyran\t40", "4\ttiny\t20"]
    info, score = _write(tmp_path, score="9\t7")
    jobs.merge_lines(spark, info, score, *names, str(tmp_path / "out"), missing="null")
    assert _lines(spark, str(tmp_path / "out"))[-1] == "9\tnull\t7"


@pytest.mark.parametrize("skew", ["auto", "salt", "none"])
def test_inner_join_of_the_sample_records(spark, skew):
    info = spark.createDataFrame([line.split("\t") for line in INFO.split("\n")], ["id", "name", "isstu", "remark"])
    score = spark.createDataFrame([line.split("\t") for line in SCORE.split("\n")], ["id", "score"])
    got = rows(inner_join(info, score, ["id"], skew=skew, hot_rows=0).select("id", "name", "score"))
    assert got == [("1", "frank", "80"), ("2", "alan", "90"), ("3", "byran", "40"), ("4", "foster", "20"), ("4", "tiny", "20")]


def _skewed(seed, n, keys):
    rng = random.Random(seed)
    out = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}", i, f"s{seed}") for i in range(n)]
    return [*out, (None, -1, "none")] + [("copy", 0, "same")] * 20


@pytest.mark.parametrize("hot_rows", [0, 5, 30])
def test_salted_join_equals_plain_join(spark, hot_rows):
    left = spark.createDataFrame(_skewed(1, 200, 30), "k string, a int, shared string").repartition(5)
    right = spark.createDataFrame(_skewed(2, 90, 40), "k string, b int, shared string").repartition(3)
    plain = inner_join(left, right, ["k"], skew="none")
    assert rows(inner_join(left, right, ["k"], skew="salt", hot_rows=hot_rows)) == rows(plain)
    assert "hot" in {r.k for r in plain.collect()} and None not in {r.k for r in plain.collect()}


def test_right_side_overrides_and_schema_conforms(spark):
    left = spark.createDataFrame([(1, "old", None, "d1"), (2, "l", "x", "d2")], "k int, v string, w string, dt string")
    right = spark.createDataFrame([(1, None, 5.0, "d3")], "k int, v string, n double, DT string")
    assert override_columns(["k", "v", "w"], ["k", "v", "n"], ["k"]) == [("l", "k"), ("r", "v"), ("l", "w"), ("r", "n")]
    assert inner_join(left, right, ["k"]).collect() == [(1, None, None, 5.0)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("n", "k", "v", "gone")])
    assert inner_join(left, right, ["k"], schema=schema, text=True).collect() == [("5.0", "1", "", "")]


def test_values_with_separators_survive(spark):
    left = spark.createDataFrame([("1", "a=b,c")], "k string, v string")
    right = spark.createDataFrame([("1", ",=")], "k string, w string")
    assert inner_join(left, right, ["k"], text=True).collect() == [("1", "a=b,c", ",=")]


def test_salting_is_used_without_adaptive_execution(spark, plan):
    left = spark.createDataFrame([("1", 1)], "k string, a int")
    right = spark.createDataFrame([("1", 2)], "k string, b int")
    assert "_hot" not in plan(inner_join(left, right, ["k"]))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert "_hot" in plan(inner_join(left, right, ["k"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    with pytest.raises(ValueError):
        inner_join(left, right, ["k"], skew="other")


def test_adaptive_execution_splits_a_large_key(spark, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB"}
    from cellframe import session_settings
    with session_settings(spark, settings):
        big = spark.range(40_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
        small = spark.range(-1, 40_000, numPartitions=4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
        joined = inner_join(big, small, ["k"])
        assert "skew=true" in plan(joined, executed=True).split("== Initial Plan ==")[0]
        assert joined.count() == 40_000


def test_hot_keys_get_salts_by_size(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", i) for i in range(10)] + [("c", 1)], "k string, i int")
    assert [r._salts for r in hot_keys(df, ["k"], hot_rows=30).collect()] == [4]
    assert [r._salts for r in hot_keys(df, ["k"]).collect()] == [4]  # 111 rows on 4 shuffle partitions
    assert hot_keys(df, ["k"], hot_rows=0).count() == 2


def test_side_counts_and_last_record(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    b = spark.createDataFrame([(1, 5), (3, 6)], "k int, n int")
    union = tagged_union({"base": a, "price": b})
    assert rows(union.select("k", "v", "n", "type"))[0] == (1, "x", None, "base")
    assert rows(side_counts(union, ["k"], "type", "base", "price")) == [(1, 2, 1, 2), (2, 1, 0, 0), (3, 0, 1, 0)]
    assert rows(last_per_key(a, ["k"], ["v"])) == [(1, "y"), (2, "z")]


def test_join_of_one_partition_of_two_tables(spark, tmp_path):
    base = spark.createDataFrame([("n1", 5), ("n2", 6)], "itemnumber string, itemgroupid int")
    price = spark.createDataFrame([("n1", "USA"), ("n1", "CAN"), ("n3", "USA")], "itemnumber string, countrycode string")
    label = "2018-09-29-08-28-33"
    for name, df in (("ItemBase", base), ("ItemPrice", price)):
        df.write.orc(str(tmp_path / name / f"dt={label}"))
        df.write.orc(str(tmp_path / name / "dt=2018-09-30-00-00-00"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("itemnumber", "itemgroupid", "countrycode")])
    out = str(tmp_path / "joined")
    jobs.join_tables(spark, str(tmp_path / "ItemBase"), str(tmp_path / "ItemPrice"), "itemnumber", label, schema, out)
    assert rows(spark.read.orc(out)) == [("n1", "5", "CAN"), ("n1", "5", "USA")]


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path, plan):
    frames = []
    for name, column in (("left", "group"), ("right", "country")):
        spark.range(200_000).select(F.col("id").alias("item"), F.lit("same").alias(column)).write.orc(str(tmp_path / name))
        frames.append(spark.read.orc(str(tmp_path / name)))
    joined = inner_join(*frames, ["item"], text=True)
    assert "Broadcast" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == 200_000
