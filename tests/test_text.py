import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe import parse_delimited, word_count
from cellframe.functions import text as tx


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text, parts", [
    ("", [""]), (" ", []), ("   ", []), ("a  b", ["a", "", "b"]), (" a ", ["", "a"]), ("a b  ", ["a", "b"]),
    ("a", ["a"]), ("a\tb", ["a\tb"])])
def test_split_drops_trailing_empties(spark, text, parts):
    assert _one(spark, tx.java_split(F.lit(text), " ")) == parts


def test_split_escapes_the_separator(spark):
    assert _one(spark, tx.java_split(F.lit("a|b||"), "|")) == ["a", "b"]
    with pytest.raises(ValueError):
        tx.java_split(F.lit("a"), "ab")


def test_word_count(spark):
    lines = spark.createDataFrame([("",), (" ",), ("a  b",), (" a ",), ("a b  ",)], "value string")
    assert {r.word: r.n for r in word_count(lines).collect()} == {"": 3, "a": 3, "b": 2}


def test_small_expressions(spark):
    assert _one(spark, tx.label(F.lit("x"), F.lit(None), F.lit(3))) == "x__3"
    assert _one(spark, tx.hex_pairs(F.lit(b"abc"))) == "61 62 63"
    assert _one(spark, tx.hex_pairs(F.lit(b""))) == ""
    assert _one(spark, tx.or_empty(F.lit(None))) == ""
    assert _one(spark, tx.partition_label(F.lit(datetime.datetime(2018, 9, 29, 8, 28, 33, 123000)))) == "20180929082833123"
    assert _one(spark, tx.count_matches(F.lit("a=b=c"), "=")) == 2
    assert _one(spark, tx.flat_name(F.lit("ns:t"))) == "ns_t"
    assert _one(spark, tx.key_text(F.lit("é".encode()))) == "é"
    assert _one(spark, tx.qualified_name(F.lit("f"), F.lit("q"))) == "f:q"
    assert _one(spark, tx.zip_to_map(["a", "b", "c"], F.array(F.lit("1"), F.lit("2")))) == {"a": "1", "b": "2"}
    assert _one(spark, tx.text_to_record(F.lit("a=b=c,d=,e"))) == {"a": "b=c", "d": "", "e": ""}


def test_parse_int(spark):
    assert _one(spark, tx.parse_int(F.lit("+5"))) == 5
    assert _one(spark, tx.parse_int(F.lit(" 5"), strict=False)) is None
    with pytest.raises(PySparkException, match="not an integer"):
        _one(spark, tx.parse_int(F.lit("99999999999")))


def test_parse_delimited_strictness(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("x", T.DoubleType())])
    lines = spark.createDataFrame([("1\t2.5",), ("2",), ("q\tr",)], "value string")
    got = {tuple(r) for r in parse_delimited(lines, schema).collect()}
    assert got == {(1, 2.5), (2, None), (None, None)}
    with pytest.raises(PySparkException):
        parse_delimited(lines, schema, strict=True).collect()
