"""Ready-made jobs: one read, one operator, one sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregate import word_count
from ..operators.assemble import assemble_from_rows, assemble_strings, assemble_tsv, dump_pairs
from ..operators.joins import inner_join, merge_as_map, merge_by_key
from ..operators.running import running_row
from ..operators.select import drop_empty_rows
from ..session import shuffle_into
from ..sinks.files import write_orc, write_orc_strings, write_sequence, write_tsv
from ..sources.cells import read_orc
from ..sources.lines import parse_delimited, read_lines
from .manifest import latest_snapshot, read_manifest, read_snapshot


def latest_cells(spark: SparkSession, root: str, table: str, families: Sequence[str]) -> DataFrame:
    """The wanted families of a table's newest snapshot."""
    manifest = read_manifest(spark, root)
    newest = latest_snapshot(manifest, table).first()
    if newest is None:
        raise ValueError(f"table {table!r} has no snapshot in {root}")
    return read_snapshot(spark, manifest, newest.snapshot, families)


def cells_to_orc(cells: DataFrame, names: Mapping[str, str], required: str | None, path: str,
                 num_files: int | None = None) -> None:
    """Text rows of the picked qualifiers, as ORC; the rows' own shuffle makes the files."""
    with shuffle_into(cells.sparkSession, num_files):
        rows = assemble_strings(cells, names, required)
        write_orc_strings(rows.select(*names.values()), path)


def cells_to_sequence(cells: DataFrame, key_qualifier: str, value_qualifier: str, path: str) -> None:
    write_sequence(assemble_tsv(cells, key_qualifier, value_qualifier), path)


def cells_to_text(cells: DataFrame, path: str, num_files: int | None = None) -> None:
    """``qualifier<TAB>value`` lines, ordered by row key in each file."""
    write_tsv(dump_pairs(cells, num_files).select("qualifier", "value"), path)


def running_rows_to_orc(cells: DataFrame, names: Mapping[str, str], path: str) -> None:
    rows = running_row(cells.withColumn("value", F.col("value").cast("string")), names)
    write_orc(rows.select(*names.values()), path)


def rows_to_orc(rows: DataFrame, names: Mapping[str, str], path: str) -> None:
    """Map-only: columns out of already grouped rows, as ORC."""
    write_orc(assemble_from_rows(drop_empty_rows(rows), names).select(*names.values()), path)


def merge_records(spark: SparkSession, info_path: str, score_path: str, info_schema: T.StructType,
                  score_schema: T.StructType, key: str, name: str, score: str, path: str) -> None:
    """Merge two tab-separated inputs by key into ``key, label, score`` lines."""
    info = parse_delimited(read_lines(spark, info_path, True), info_schema, strict=True, keep=["position"])
    points = parse_delimited(read_lines(spark, score_path, True), score_schema, strict=True, keep=["position"])
    merged = merge_by_key(info, points, key, name=name, score_column=score,
                          info_order=["position"], score_order=["position"])
    write_tsv(merged, path)


def merge_lines(spark: SparkSession, left_path: str, right_path: str, left_names: Sequence[str],
                right_names: Sequence[str], columns: Sequence[str], path: str,
                missing: str | None = None) -> None:
    """Untyped merge of two tab-separated inputs on their first field."""
    merged = merge_as_map(read_lines(spark, left_path, True), read_lines(spark, right_path, True),
                          left_names, right_names, columns, missing=missing)
    write_tsv(merged, path)


def join_tables(spark: SparkSession, left_path: str, right_path: str, key: str, label: str,
                schema: T.StructType, path: str, partition: str = "dt") -> None:
    """Inner join of one partition of two ORC tables into all-text ORC."""
    left = read_orc(spark, left_path, partition=partition, label=label)
    right = read_orc(spark, right_path, partition=partition, label=label)
    write_orc(inner_join(left, right, [key], schema=schema, without=[partition], text=True), path)


def count_words(spark: SparkSession, paths: str | Sequence[str], path: str) -> None:
    """``word<TAB>count`` lines, ordered by word in each file."""
    write_tsv(word_count(read_lines(spark, paths)), path, sort_by=["word"])
