"""Byte-to-type expressions.

A stored value is either the text of a number or its big-endian bytes. The
default ``auto`` reading tries the text first and falls back to the bytes;
``text`` and ``binary`` declare the one form that is really used.

Every ``…_sql`` function writes one Spark SQL expression over a binary
expression; it gives NULL for a value it cannot read. ``decode`` makes a
``Column`` of it and turns that NULL into an error on request. One parsed
expression per column keeps plans quick to build for tables of many columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sql import name_sql, text_sql

# Number spellings accepted as text.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_TEXT = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity"
    r"|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?"
    r")[\x00-\x20]*$"
)

# Milliseconds whose microseconds still fit a long.
_MAX_MILLIS = 9223372036854775

_INTEGER_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}


def _as_text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def _when(condition: str, result: str, otherwise: str = "NULL") -> str:
    return f"CASE WHEN {condition} THEN {result} ELSE {otherwise} END"


def _matching_text(value: str, pattern: str) -> str:
    return _when(f"{_as_text(value)} RLIKE r'{pattern}'", _as_text(value))


def _choose(encoding: str, text: str, binary: str) -> str:
    if encoding == "text":
        return text
    if encoding == "binary":
        return binary
    return f"coalesce({text}, {binary})"


def _number(digits: str) -> str:
    """Up to 15 hexadecimal digits as a long."""
    return f"CAST(conv({digits}, 16, 10) AS BIGINT)"


def _signed(value: str, width: int) -> str:
    """The leading big-endian two's-complement integer; NULL when too short."""
    digits = f"hex(substring({value}, 1, {width}))"
    if width == 8:
        number = f"CAST(conv({digits}, 16, -10) AS BIGINT)"
    else:
        span, half = 1 << (8 * width), 1 << (8 * width - 1)
        number = f"(pmod({_number(digits)} + {half}L, {span}L) - {half}L)"
    return _when(f"octet_length({value}) >= {width}", number)


def integer_sql(value: str, type_name: str, encoding: str) -> str:
    text = f"TRY_CAST({_matching_text(value, INTEGER_TEXT)} AS {type_name})"
    return _choose(encoding, text, f"CAST({_signed(value, _INTEGER_WIDTH[type_name])} AS {type_name})")


def boolean_sql(value: str, encoding: str) -> str:
    """One byte is true unless zero; anything longer is true for the text ``true``."""
    text, raw, one_byte = f"lower({_as_text(value)}) = 'true'", f"hex({value}) <> '00'", f"octet_length({value}) = 1"
    if encoding == "text":
        return text
    return _when(one_byte, raw, text if encoding == "auto" else "NULL")


def tinyint_sql(value: str, encoding: str) -> str:
    """One byte is that byte; anything longer must be integer text."""
    raw = f"CAST({_signed(value, 1)} AS TINYINT)"
    text = f"TRY_CAST({_matching_text(value, INTEGER_TEXT)} AS TINYINT)"
    if encoding == "text":
        return text
    return _when(f"octet_length({value}) = 1", raw, text if encoding == "auto" else "NULL")


def _ieee_number(bits: str, size: int, fraction_bits: int) -> str:
    """The double whose sign, exponent and fraction are in a long; exact, as it only scales by powers of two."""
    top, bias = (1 << (size - 1 - fraction_bits)) - 1, (1 << (size - 2 - fraction_bits)) - 1
    exponent = f"(shiftrightunsigned({bits}, {fraction_bits}) & {top})"
    fraction = f"({bits} & {(1 << fraction_bits) - 1}L)"
    special = _when(f"{fraction} = 0", "double('Infinity')", "double('NaN')")
    whole = _when(f"{exponent} = 0", fraction, f"{fraction} + {1 << fraction_bits}L")
    number = f"CAST({whole} AS DOUBLE) * pow(2D, greatest({exponent}, 1L) - {bias + fraction_bits})"
    sign = _when(f"{bits} < 0" if size == 64 else f"{bits} >= {1 << (size - 1)}", "-1D", "1D")
    return f"{sign} * {_when(f'{exponent} = {top}', special, number)}"


def _float_bytes(value: str) -> str:
    bits = _number(f"hex(substring({value}, 1, 4))")
    return _when(f"octet_length({value}) >= 4", f"CAST({_ieee_number(bits, 32, 23)} AS FLOAT)")


def _double_bytes(value: str) -> str:
    bits = f"CAST(conv(hex(substring({value}, 1, 8)), 16, -10) AS BIGINT)"
    return _when(f"octet_length({value}) >= 8", _ieee_number(bits, 64, 52))


def _long_integer_text(digits: str) -> str:
    """The decimal text of a two's-complement integer of any width, from its hexadecimal digits.

    The number is built up in groups of nine decimal digits, lowest first, four
    hexadecimal digits at a time. A negative number is minus (its complement plus one).
    """
    grown = """transform(array(aggregate(g, named_struct('g', CAST(array() AS array<bigint>), 'c', {add}),
        (s, x) -> named_struct('g', concat(s.g, array((x * {times} + s.c) % 1000000000L)), 'c', (x * {times} + s.c) DIV 1000000000L))),
        s -> CASE WHEN s.c > 0 THEN concat(s.g, array(s.c)) ELSE s.g END)[0]"""
    step = grown.format(add="CAST(conv(part, 16, 10) AS BIGINT)", times="65536L")
    plus_one = grown.format(add="1L", times="1L")
    negative = "substring(h, 1, 1) >= '8'"
    return f"""transform(array({digits}), h ->
      transform(array({_when(negative, "translate(h, '0123456789ABCDEF', 'FEDCBA9876543210')", "h")}), m ->
        transform(array(lpad(m, CAST(ceil(length(m) / 4) * 4 AS INT), '0')), p ->
          transform(array(aggregate(transform(sequence(1, length(p), 4), i -> substring(p, i, 4)), array(0L),
            (g, part) -> {step}, g -> {_when(negative, plus_one, "g")})), g ->
            concat({_when(negative, "'-'", "''")}, CAST(element_at(g, -1) AS STRING),
              array_join(transform(reverse(slice(g, 1, size(g) - 1)), x -> lpad(CAST(x AS STRING), 9, '0')), '')))[0])[0])[0])[0]"""


def _decimal_bytes(value: str) -> str:
    """Text for four bytes of scale and a two's-complement integer of at least one byte."""
    digits = f"hex(substring({value}, 5))"
    fill = _when(f"substring({digits}, 1, 1) >= '8'", "'F'", "'0'")
    padded = f"lpad({digits}, 32, {fill})"
    # The upper eight bytes are signed, the lower ones are not.
    upper = f"CAST(conv(substring({padded}, 1, 16), 16, -10) AS DECIMAL(38,0))"
    lower = f"CAST(conv(substring({padded}, 17, 16), 16, 10) AS DECIMAL(38,0))"
    number = f"try_add(try_multiply({upper}, CAST('{1 << 64}' AS DECIMAL(38,0))), {lower})"
    short = _when(f"octet_length({value}) BETWEEN 5 AND 20", f"CAST({number} AS STRING)")
    # What a DECIMAL(38,0) cannot hold may still fit with its scale.
    text = f"coalesce({short}, {_when(f'octet_length({value}) > 4', _long_integer_text(digits))})"
    # A scale beyond these bounds gives zero or an overflow all the same.
    most = f"3 * octet_length({value}) + 99"
    exponent = f"-greatest(least({_signed(value, 4)}, {most}), -99)"
    return f"concat({text}, 'E', CAST({exponent} AS STRING))"


def _from_text(value: str, pattern: str, bytes_text: str, type_name: str, encoding: str) -> str:
    """Number text, or the text of a binary number, through one cast."""
    return f"TRY_CAST({_choose(encoding, _matching_text(value, pattern), bytes_text)} AS {type_name})"


def float_sql(value: str, encoding: str) -> str:
    return _choose(encoding, f"TRY_CAST({_matching_text(value, FLOAT_TEXT)} AS FLOAT)", _float_bytes(value))


def double_sql(value: str, encoding: str) -> str:
    return _choose(encoding, f"TRY_CAST({_matching_text(value, FLOAT_TEXT)} AS DOUBLE)", _double_bytes(value))


def decimal_sql(value: str, precision: int, scale: int, encoding: str) -> str:
    return _from_text(value, DECIMAL_TEXT, _decimal_bytes(value), f"decimal({precision},{scale})", encoding)


def string_sql(value: str, length: int | None = None) -> str:
    """UTF-8 text; bytes that are not UTF-8 never fail, text above a declared length does not fit."""
    text = _as_text(value)
    return text if length is None else _when(f"char_length({text}) <= {length}", text)


def timestamp_sql(value: str, encoding: str) -> str:
    """Milliseconds since 1970 as text or an 8-byte integer."""
    millis = integer_sql(value, "bigint", encoding)
    return _when(f"{millis} BETWEEN -{_MAX_MILLIS} AND {_MAX_MILLIS}", f"timestamp_millis({millis})")


def date_sql(value: str, encoding: str) -> str:
    """The session-zone day of a millisecond timestamp."""
    return f"to_date({timestamp_sql(value, encoding)})"


def decode_sql(value: str, data_type: T.DataType, encoding: str) -> str:
    """The expression that reads ``value`` as ``data_type``; nested types are rejected."""
    match data_type:
        case T.BooleanType():
            return boolean_sql(value, encoding)
        case T.ByteType():
            return tinyint_sql(value, encoding)
        case T.ShortType() | T.IntegerType() | T.LongType():
            return integer_sql(value, data_type.simpleString(), encoding)
        case T.FloatType():
            return float_sql(value, encoding)
        case T.DoubleType():
            return double_sql(value, encoding)
        case T.DecimalType():
            return decimal_sql(value, data_type.precision, data_type.scale, encoding)
        case T.VarcharType() | T.CharType():
            return string_sql(value, data_type.length)
        case T.StringType():
            return string_sql(value)
        case T.DateType():
            return date_sql(value, encoding)
        case T.TimestampType():
            return timestamp_sql(value, encoding)
        case T.BinaryType():
            return value
    raise ValueError(f"cannot decode into {data_type.simpleString()}")


def decode(column: str, data_type: T.DataType, encoding: str = "auto", on_error: str = "null",
           name: str | None = None) -> Column:
    """A binary column read as ``data_type``; unreadable bytes are NULL or an error.

    ``on_error`` is ``'null'`` or ``'fail'``. A NULL value stays NULL. ``name`` is
    an SQL expression for the name used in the error, by default the column's.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    value = name_sql(column)
    decoded = decode_sql(value, data_type, encoding)
    if on_error == "null":
        return F.expr(decoded)
    kind = data_type.simpleString()
    message = f"concat('cannot decode ', {name or text_sql(column)}, ' as {kind}: 0x', hex({value}))"
    # Text of any declared length is a string inside Spark.
    result = "string" if isinstance(data_type, (T.VarcharType, T.CharType)) else kind
    broken = f"CASE WHEN {value} IS NOT NULL THEN CAST(raise_error({message}) AS {result}) END"
    return F.expr(f"coalesce({decoded}, {broken})")
