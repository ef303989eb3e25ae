"""Cell filters and projections. None of them shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..model import ColumnSpec


def map_columns(cells: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Keep the mapped cells and add their ``target`` column and ``slot`` number.

    The mapping is as small as the arguments it is written in, so it is always
    broadcast. The explicit value lists repeat the join condition in a form that
    reaches the file scan. A source column mapped twice gives two rows.
    """
    # An Arrow table becomes a local relation with a known, tiny size.
    mapping = cells.sparkSession.createDataFrame(pa.table({
        "family": [c.family for c in columns],
        "qualifier": [c.qualifier for c in columns],
        "target": [c.target for c in columns],
        "slot": pa.array(range(len(columns)), pa.int32()),
    }))
    wanted = cells.where(
        F.col("family").isin(sorted({c.family for c in columns}))
        & F.col("qualifier").isin(sorted({c.qualifier for c in columns})))
    return wanted.join(F.broadcast(mapping), ["family", "qualifier"])


def pick_qualifiers(cells: DataFrame, names: Mapping[str, str],
                    ignore_case: bool = True) -> DataFrame:
    """Keep the cells with the given qualifiers and add ``target`` and ``slot``.

    ``names`` maps a qualifier to its target column.
    """
    found = F.lower("qualifier") if ignore_case else F.col("qualifier")
    wanted = [q.lower() if ignore_case else q for q in names]
    target, slot = F.lit(None).cast("string"), F.lit(None).cast("int")
    for index, (qualifier, name) in reversed(list(enumerate(zip(wanted, names.values())))):
        target = F.when(found == qualifier, F.lit(name)).otherwise(target)
        slot = F.when(found == qualifier, F.lit(index)).otherwise(slot)
    return cells.where(found.isin(wanted)).withColumns({"target": target, "slot": slot})


def families(cells: DataFrame, *names: str) -> DataFrame:
    """Only the named families; also accepts one comma-separated list."""
    wanted = [part for name in names for part in name.split(",") if part]
    return cells.where(F.col("family").isin(wanted))


def require(df: DataFrame, column: str) -> DataFrame:
    """Rows in which a column is present."""
    return df.where(F.col(column).isNotNull())


def require_nonempty(df: DataFrame, column: str) -> DataFrame:
    """Rows in which a text column is present and not empty."""
    return df.where(F.length(column) > 0)


def drop_empty_rows(rows: DataFrame) -> DataFrame:
    """Grouped rows that hold at least one cell."""
    return rows.where(F.size("cells") > 0)


def key_range(cells: DataFrame, lo: str | None = None, hi: str | None = None,
              key: str = "row_key") -> DataFrame:
    """Cells with ``lo <= key < hi``, in byte order; reaches the file scan."""
    if lo is not None:
        cells = cells.where(F.col(key) >= lo)
    if hi is not None:
        cells = cells.where(F.col(key) < hi)
    return cells


def show_cells(cells: DataFrame) -> DataFrame:
    """Row key, family, qualifier, qualified name and value, all as text."""
    return cells.select(
        tx.key_text(F.col("row_key")).alias("row_key"),
        "family",
        "qualifier",
        tx.qualified_name(F.col("family"), F.col("qualifier")).alias("name"),
        F.col("value").cast("string").alias("value"),
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Without the named columns, in any letter case."""
    unwanted = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in unwanted])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns; an absent one is NULL."""
    present = {c.lower(): c for c in df.columns}

    def pick(field: T.StructField) -> Column:
        if field.name.lower() in present:
            source = F.col(f"`{present[field.name.lower()]}`")
        else:
            source = F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in schema.fields])


def with_partition(df: DataFrame, name: str, value: str) -> DataFrame:
    """The same label on every row."""
    return df.withColumn(name, F.lit(value))


def cells_to_pairs(cells: DataFrame) -> DataFrame:
    return cells.select("row_key", "qualifier", "value")
