"""File sinks. Every one replaces what its path held before."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_empty
from ..scratch import remove_dir, replace_dir


def into_files(df: DataFrame, num_files: int | None, key: Sequence[str] = ()) -> DataFrame:
    """Spread over a fixed number of output files; ``None`` keeps the partitions."""
    return df if num_files is None else df.repartition(num_files, *key)


def write_orc(df: DataFrame, path: str, num_files: int | None = None) -> None:
    into_files(df, num_files).write.mode("overwrite").orc(path)


def write_orc_strings(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """ORC with every column as text."""
    write_orc(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]), path, num_files)


def write_tsv(df: DataFrame, path: str, num_files: int | None = None,
              sort_by: Sequence[str] = ()) -> None:
    """Columns joined by tabs; ``sort_by`` orders each file's lines.

    A NULL in the first column leaves out that column, any other NULL is empty text.
    """
    spread = into_files(df, num_files)
    if sort_by:
        spread = spread.sortWithinPartitions(*sort_by)
    first, *rest = [F.col(f"`{c}`") for c in df.columns]
    spread.select(F.concat_ws("\t", first.cast("string"), *[or_empty(c) for c in rest]).alias("value")).write.mode("overwrite").text(path)


def write_sequence(df: DataFrame, path: str, column: str = "line") -> None:
    """A SequenceFile with null keys and one text column as values.

    Spark SQL has no writer for this format, so this goes through an RDD.
    """
    remove_dir(df.sparkSession, path)
    df.select(column).rdd.map(lambda row: (None, row[0])).saveAsHadoopFile(
        path,
        "org.apache.hadoop.mapred.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.NullWritable",
        valueClass="org.apache.hadoop.io.Text")


def partition_path(root: str, table: str, partition: str, label: str) -> str:
    return f"{root.rstrip('/')}/{table}/{partition}={label}"


def write_run(df: DataFrame, root: str, table: str, partition: str, label: str,
              num_files: int | None = None, by: str | None = None) -> str:
    """Write one partition's rows into a directory of this run alone; gives its path.

    Nothing that an earlier run wrote is touched. The label lives in the directory name
    only, not in the files. With ``by`` each value of that column has a directory in it.
    """
    path = f"{partition_path(root, table, partition, label)}/run-{uuid.uuid4().hex}"
    rows = into_files(df.drop(partition), num_files).write.mode("overwrite")
    (rows if by is None else rows.partitionBy(by)).orc(path)
    return path


def write_partition(df: DataFrame, root: str, table: str, partition: str, label: str,
                    num_files: int | None = None) -> str:
    """Write the ``partition=label`` directory of a table; gives its path.

    Rows are written beside it first and take its place once they are complete, so a
    failed run leaves the old rows. The move itself is two renames; tables that are
    read meanwhile are switched by ``replace_partition`` instead.
    """
    spark, path = df.sparkSession, partition_path(root, table, partition, label)
    fresh = f"{root.rstrip('/')}/{table}/_run-{uuid.uuid4().hex}"
    write_orc(df.drop(partition), fresh, num_files)
    replace_dir(spark, fresh, path)
    return path
