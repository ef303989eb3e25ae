"""Cell tables in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CELL
from ..session import packed_scans


def read_cells(spark: SparkSession, paths: str | Sequence[str], format: str = "parquet", *,
               recursive: bool = False, glob: str | None = None, base: str | None = None) -> DataFrame:
    """All cells of one or more files or directories.

    Nothing but the needed columns, families and key ranges is read once the
    caller filters. Names starting with ``_`` or ``.`` are skipped. ``base`` is the
    directory above ``family=…`` directories when ``paths`` point inside them.
    """
    reader = spark.read.format(format).schema(CELL)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if base:
        reader = reader.option("basePath", base)
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def read_orc(spark: SparkSession, paths: str | Sequence[str], *, partition: str | None = None,
             label: str | None = None) -> DataFrame:
    """ORC files with the schema found in them, or one ``partition=label`` of a table.

    With a label only that partition's directories are listed, and the columns are
    those of its own files; several tables must have the same ones. A partition label
    is always text, even if it is all digits.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if partition is None:
        return spark.read.orc(paths)
    if label is None:
        schema = spark.read.orc(paths).schema
        return spark.read.schema(_with_text_column(schema, partition)).orc(paths)
    rows = None
    for path in paths:
        directory = f"{path.rstrip('/')}/{partition}={label}"
        schema = _with_text_column(spark.read.orc(directory).schema, partition)
        one = spark.read.schema(schema).option("basePath", path).orc(directory)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _with_text_column(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*(f for f in schema if f.name != name), T.StructField(name, T.StringType())])


def unpivot_to_cells(df: DataFrame, key: str, family: str | dict[str, str], columns: Sequence[str], *,
                     ts: Column | None = None, seq: Column | None = None) -> DataFrame:
    """A wide table as cells: one text value per row and present column.

    ``family`` is one name or a family per column. There is no shuffle.
    """
    def cell(name: str) -> Column:
        return F.struct(
            F.lit(family if isinstance(family, str) else family[name]).alias("family"),
            F.lit(name).alias("qualifier"),
            F.col(name).cast("string").cast("binary").alias("value"))

    cells = df.select(
        F.col(key).cast("string").alias("row_key"),
        F.explode(F.array(*[cell(c) for c in columns])).alias("cell"),
        (F.lit(0) if ts is None else ts).cast("bigint").alias("ts"),
        (F.lit(0) if seq is None else seq).cast("bigint").alias("seq"))
    return cells.where(F.col("cell.value").isNotNull()).select("row_key", "cell.*", "ts", "seq")


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 << 20,
            format: str = "parquet") -> None:
    """Rewrite many small files as fewer files, without a shuffle.

    ``target`` must differ from ``source``: a table is never overwritten while it
    is being read.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into another directory")
    with packed_scans(spark, file_bytes):
        spark.read.format(format).load(source).write.format(format).mode("overwrite").save(target)
