"""Schemas and table mappings shared by every module.

A *cell* is one (row key, family, qualifier, value) fact with a version
``(ts, seq)``; a *spec* says which cells become which typed columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

CELL = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
])

ROWS = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("cells", T.ArrayType(T.StructType(CELL.fields[1:]))),
])

MANIFEST = T.StructType([
    T.StructField("snapshot", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("creation_time", T.TimestampType()),
    T.StructField("family", T.StringType()),
    T.StructField("live_path", T.StringType()),
    T.StructField("archive_path", T.StringType()),
])

# Columns that decide which version of a cell is the newest.
VERSION = ("ts", "seq")

ENCODINGS = ("auto", "text", "binary")

# The column types a mapping may declare.
_PLAIN_TYPES = {
    "boolean": T.BooleanType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def parse_type(text: str) -> T.DataType:
    """Spark type for a declared type name, in any letter case.

    ``varchar`` and ``char`` without a length are plain strings; ``decimal``
    without digits is ``decimal(38,10)``, so no stored digit is lost.
    """
    match = re.fullmatch(r"\s*([a-z]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", text.lower())
    if match is None:
        raise ValueError(f"type not supported: {text!r}")
    name, first, second = match.groups()
    if name == "decimal":
        return T.DecimalType(int(first), int(second or 0)) if first else T.DecimalType(38, 10)
    if name in ("varchar", "char") and second is None:
        if first is None:
            return T.StringType()
        return T.VarcharType(int(first)) if name == "varchar" else T.CharType(int(first))
    if name not in _PLAIN_TYPES or first is not None:
        raise ValueError(f"type not supported: {text!r}")
    return _PLAIN_TYPES[name]


@dataclass(frozen=True)
class ColumnSpec:
    """One mapped column: the source cell, its declared type and target name."""

    family: str
    qualifier: str
    type: str
    target: str
    encoding: str = "auto"

    def __post_init__(self) -> None:
        parse_type(self.type)
        if self.encoding not in ENCODINGS:
            raise ValueError(f"encoding must be one of {ENCODINGS}, not {self.encoding!r}")

    @property
    def spark_type(self) -> T.DataType:
        return parse_type(self.type)


@dataclass(frozen=True)
class ExportSpec:
    """How one cell table becomes one published table.

    ``num_files`` and ``max_partition_bytes`` set the number of output files
    and how many input bytes one scan task packs together.
    """

    source: str
    table: str
    columns: tuple[ColumnSpec, ...]
    num_files: int | None = None
    max_partition_bytes: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        if not self.columns:
            raise ValueError("a mapping needs at least one column")
        names = [c.target.lower() for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"target columns are not unique: {names}")

    @property
    def families(self) -> list[str]:
        return distinct_families(self.columns)

    @property
    def schema(self) -> T.StructType:
        return schema_of(self.columns)


def distinct_families(columns) -> list[str]:
    """Families a mapping reads, each once, in first-use order."""
    return list(dict.fromkeys(c.family for c in columns))


def schema_of(columns) -> T.StructType:
    return T.StructType([T.StructField(c.target, c.spark_type) for c in columns])


def schema_string(columns) -> str:
    """The mapping's schema as ``struct<name:type,…>``."""
    return schema_of(columns).simpleString()


def extend_schema(schema: T.StructType, name: str) -> T.StructType:
    """A copy of ``schema`` with a trailing string column."""
    return T.StructType([*schema.fields, T.StructField(name, T.StringType())])
