import datetime
import math
import random
import struct
from decimal import Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from cellframe import ColumnSpec, decode_columns, decode_rejects, rejected_rows
from cellframe.functions.decode import decode
from cellframe.model import parse_type

UTC = datetime.timezone.utc
MOMENT = datetime.datetime(2018, 9, 29, 8, 28, 33, 123000)


def _decoded(spark, values, type_name, encoding="auto", on_error="null"):
    data = [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "i int, b binary").repartition(2)
    out = decode("b", parse_type(type_name), encoding, on_error)
    return [r.v for r in df.select("i", out.alias("v")).orderBy("i").collect()]


CASES = {
    "boolean": [(b"TRUE", True), (b"no", False), (b"\x00", False), (b"\x01", True), (b"0", True),
                (b"", False), (b"\xff\xfe", False), (None, None)],
    "tinyint": [(b"-12", -12), (b"\x7f", 127), (b"\x80", -128), (b"5", 53), (b"128", None), (b"", None),
                (b"x1", None), (b"\xff\xff", None), (None, None)],
    "smallint": [(b"+300", 300), (b"\xff\xfe", -2), (b"\x80\x00", -32768), (b"-32768", -32768), (b"7", 7),
                 (b"x", None), (b"", None), (b"40000", 0x3430), (None, None)],
    "int": [(b"42", 42), (b"\x80\x00\x00\x01", -2147483647), (b"\xff\xff\xff\xff", -1), (b"1234", 1234),
            (b"-2147483648", -2147483648), (b" 5", None), (b"1.5", None), (b"", None), (b"\x01\x02\x03", None),
            (b"word", 0x776F7264), (b"99999999999", 0x39393939), (None, None)],
    "bigint": [(b"1538209713123", 1538209713123), (b"\x80" + b"\x00" * 7, -(1 << 63)), (b"\xff" * 8, -1),
               (b"9223372036854775807", (1 << 63) - 1), (b"1234567", 1234567), (b"seven77", None), (b"", None),
               (None, None)],
    "float": [(b"1.5", 1.5), (b"\x3f\xc0\x00\x00", 1.5), (b" 2.5 ", 2.5), (b"1e3f", 1000.0),
              (b"abc", None), (b"", None), (b"\xff\x80\x00\x00", -math.inf), (None, None)],
    "double": [(b"1.5", 1.5), (b"\x3f\xf8" + b"\x00" * 6, 1.5), (b"0x1p3", 8.0), (b"1.0d", 1.0),
               (b"Infinity", math.inf), (b"inf", None), (b"nan", None), (b"", None), (None, None)],
    "string": [(b"abc", "abc"), (b"", ""), ("é".encode(), "é"), (None, None)],
    "varchar(2)": [(b"abc", None), (b"ab", "ab"), ("éé".encode(), "éé"), (None, None)],
    "date": [(b"1538209713123", datetime.date(2018, 9, 29)),
             (struct.pack(">q", 1538209713123), datetime.date(2018, 9, 29)), (b"-1", datetime.date(1969, 12, 31)),
             (b"not a day", None), (b"", None), (None, None)],
    "timestamp": [(b"1538209713123", MOMENT), (struct.pack(">q", 1538209713123), MOMENT), (b"", None), (None, None)],
    "binary": [(b"\xff\x00", bytearray(b"\xff\x00")), (b"", bytearray()), (None, None)],
    "decimal(10,2)": [(b"12.34", Decimal("12.34")), (bytes.fromhex("0000000204D2"), Decimal("12.34")),
                      (bytes.fromhex("00000002FB2E"), Decimal("-12.34")), (b"1.239", Decimal("1.24")),
                      (b"12e3", Decimal("12000.00")), (b" 1", None), (b"", None), (b"\x00\x00\x00\x02", None),
                      (b"123456789012", None), (None, None)],
}


@pytest.mark.parametrize("type_name", CASES)
def test_decode_table(spark, type_name):
    values, expected = zip(*CASES[type_name])
    assert _decoded(spark, values, type_name) == list(expected)


def test_non_utf8_text_does_not_fail(spark):
    assert len(_decoded(spark, [b"\xff\xfeab"], "string")[0]) >= 2


def test_encoding_selects_one_form(spark):
    assert _decoded(spark, [b"1234", b"\x00\x00\x00\x07"], "int", "text") == [1234, None]
    assert _decoded(spark, [b"1234", b"\x00\x00\x00\x07"], "int", "binary") == [0x31323334, 7]
    assert _decoded(spark, [b"5"], "tinyint", "text") == [5]
    assert _decoded(spark, [b"0"], "boolean", "text") == [False]


def test_random_round_trips(spark):
    rng = random.Random(11)
    for type_name, code, size in (("smallint", ">h", 2), ("int", ">i", 4), ("bigint", ">q", 8),
                                  ("float", ">f", 4), ("double", ">d", 8)):
        raw = [rng.randbytes(size) for _ in range(500)] + [b"\x00" * size, b"\x80" + b"\x00" * (size - 1)]
        got = _decoded(spark, raw, type_name, "binary")
        for data, value in zip(raw, got):
            wanted = struct.unpack(code, data)[0]
            assert (math.isnan(value) if wanted != wanted else struct.pack(code, value) == data)
    numbers = [rng.uniform(-1e9, 1e9) for _ in range(300)]
    assert _decoded(spark, [repr(n).encode() for n in numbers], "double") == numbers


def test_decimal_bytes_of_any_width(spark):
    rng = random.Random(5)
    cases = []
    for width in range(1, 17):
        unscaled = rng.randrange(-(10 ** 37), 10 ** 37) if width == 16 else rng.randrange(
            -(1 << (8 * width - 1)), 1 << (8 * width - 1))
        size = max(1, (unscaled.bit_length() + 8) // 8)
        cases.append((unscaled, struct.pack(">i", 10) + unscaled.to_bytes(size, "big", signed=True)))
    got = _decoded(spark, [c[1] for c in cases], "decimal(38,10)", "binary")
    with localcontext(prec=60):
        assert [int(g.scaleb(10)) for g in got] == [c[0] for c in cases]


def test_long_decimals_that_fit_with_their_scale(spark):
    cases = [(12345678901234567890 * 10 ** 20, 22, 17), (3 * 10 ** 40, 35, 18), (123 * 10 ** 42, 40, 20), (-(10 ** 60) - 1, 45, 27),
             (15 * 10 ** 37, 30, 16), (-(1 << 127), 30, 16), (-(1 << 200), 60, 30), (7 * 10 ** 120, 115, 60), (0, 3, 40), (-1, 0, 33)]
    raw = [struct.pack(">i", scale) + unscaled.to_bytes(size, "big", signed=True) for unscaled, scale, size in cases]
    got = _decoded(spark, raw, "decimal(38,10)", "binary")
    with localcontext(prec=200):
        assert got == [Decimal(u).scaleb(-s).quantize(Decimal(1).scaleb(-10), "ROUND_HALF_UP") for u, s, _ in cases]
    assert _decoded(spark, [struct.pack(">i", 0) + (10 ** 60).to_bytes(30, "big")], "decimal(38,10)", "binary") == [None]


def test_text_above_its_length_is_an_error_or_a_reject(spark):
    df = spark.createDataFrame([(bytearray(b"abcdefghij"),), (bytearray(b"abc"),), (None,)], "b binary")
    columns = [ColumnSpec("f", "b", "varchar(3)", "b")]
    assert [tuple(r) for r in decode_rejects(df, columns).collect()] == [("b", 2, 1)]
    assert [bytes(r.b) for r in rejected_rows(df, columns).collect()] == [b"abcdefghij"]
    assert sorted(r.b or "" for r in decode_columns(df, columns, "null").collect()) == ["", "", "abc"]
    with pytest.raises(PySparkException):
        decode_columns(df, columns).collect()


def test_extreme_decimal_scale_is_harmless(spark):
    raw = [struct.pack(">i", 2_000_000_000) + b"\x05", struct.pack(">i", -2_000_000_000) + b"\x05"]
    assert _decoded(spark, raw, "decimal(10,2)", "binary") == [Decimal("0.00"), None]


def test_on_error_fail_names_the_column(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "n binary")
    spec = [ColumnSpec("f", "n", "int", "n")]
    with pytest.raises(PySparkException, match="cannot decode n as int: 0x78"):
        decode_columns(df, spec).collect()
    assert decode_columns(df, spec, "null").first().n is None
    nothing = spark.createDataFrame([(None,)], "n binary")
    assert decode_columns(nothing, spec).first().n is None


def test_rejects(spark):
    df = spark.createDataFrame(
        [(1, bytearray(b"7"), bytearray(b"x")), (2, bytearray(b"q"), None), (3, bytearray(b"8"), bytearray(b"1.5"))],
        "id int, a binary, b binary")
    specs = [ColumnSpec("f", "a", "int", "a"), ColumnSpec("f", "b", "double", "b", "text")]
    assert {tuple(r) for r in decode_rejects(df, specs).collect()} == {("a", 3, 1), ("b", 2, 1)}
    assert {(r.id, tuple(r.rejects)) for r in rejected_rows(df, specs).collect()} == {(1, ("b",)), (2, ("a",))}


@pytest.mark.parametrize("bad", ["array<int>", "map<string,int>", "struct<a:int>", "interval", "int(3)"])
def test_unsupported_types_are_rejected(bad):
    with pytest.raises(ValueError):
        ColumnSpec("f", "q", bad, "t")


def test_types_in_any_case():
    assert parse_type("BigInt") == T.LongType()
    assert parse_type("DECIMAL( 10 , 2 )") == T.DecimalType(10, 2)
    assert parse_type("decimal") == T.DecimalType(38, 10)
    assert parse_type("varchar") == T.StringType()


def test_every_kind_of_binary_float(spark):
    rng = random.Random(9)
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, 1.0]
    raw = [struct.pack(">d", x) for x in edges] + [rng.randbytes(8) for _ in range(500)]
    got = _decoded(spark, raw, "double", "binary")
    assert [repr(g) for g in got] == [repr(struct.unpack(">d", r)[0]) for r in raw]
    raw = [struct.pack(">f", x) for x in (0.0, -0.0, 1e-45, -1.17549435e-38, 3.4028234e38, math.inf, -math.inf)] + [rng.randbytes(4) for _ in range(500)]
    got = _decoded(spark, raw, "float", "binary")
    assert [repr(g) for g in got] == [repr(struct.unpack(">f", r)[0]) for r in raw]
