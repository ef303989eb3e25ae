"""Decoding whole tables of raw bytes, and reporting what does not decode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import decode
from ..model import ColumnSpec


def decode_columns(df: DataFrame, columns: Sequence[ColumnSpec], on_error: str = "fail") -> DataFrame:
    """Every declared column decoded in one projection; other columns stay."""
    typed = {c.target: decode(c.target, c.spark_type, c.encoding, on_error) for c in columns}
    return df.withColumns(typed)


def _failed(column: ColumnSpec) -> Column:
    decoded = decode(column.target, column.spark_type, column.encoding)
    return F.col(column.target).isNotNull() & decoded.isNull()


def decode_rejects(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per column: values present, and how many of them do not decode. One pass."""
    counts = df.agg(F.array(*[
        F.struct(
            F.lit(c.target).alias("column"),
            F.count(c.target).alias("present"),
            F.count_if(_failed(c)).alias("rejected"),
        ) for c in columns]).alias("counts"))
    return counts.select(F.inline("counts"))


def rejected_rows(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """The rows with undecodable values, and those columns' names in ``rejects``."""
    names = F.array_compact(F.array(*[F.when(_failed(c), F.lit(c.target)) for c in columns]))
    return df.withColumn("rejects", names).where(F.size("rejects") > 0)
