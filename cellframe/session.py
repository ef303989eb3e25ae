"""Session settings that apply to the jobs run inside a ``with`` block."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark joins the expressions of many decoded columns into one Java method. Above
# 8000 bytes the JVM never compiles it; with this limit Spark splits it instead.
COMPILED_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set the given options and put the former ones back afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def tasks_for(df: DataFrame, task_bytes: int = 64 << 20) -> int:
    """Tasks so that each gets about ``task_bytes`` of a frame, by Spark's estimate of it.

    At least as many as the session has shuffle partitions; so many too where Spark knows
    no size, as of rows that are in no file.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size >= 1 << 60 else max(least, -(-size // task_bytes))


def spread_rows(df: DataFrame, times: int, task_rows: int = 1_000_000) -> DataFrame:
    """The same rows dealt over tasks, so that each has about ``task_rows`` once a row is ``times`` rows.

    Scans are cut by the bytes of files, and a few MB of well-compressed rows can become more
    cells than a task should sort. Rows move before they multiply; the files' footers count them.
    """
    tasks = -(-df.count() * times // task_rows)
    return df.repartition(tasks) if tasks > 1 else df


def shuffle_into(spark: SparkSession, num_partitions: int | None):
    """Let a job's own shuffle deal its rows into this many partitions.

    A fixed number of output files then needs no shuffle besides the one by key.
    ``None`` changes nothing.
    """
    settings = {} if num_partitions is None else {
        "spark.sql.shuffle.partitions": str(num_partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    return session_settings(spark, settings)


def packed_scans(spark: SparkSession, max_partition_bytes: int | None):
    """Let each scan task read up to this many bytes of (small) files.

    Files count by their bytes alone, however many a task opens. ``None`` changes nothing.
    """
    settings = {} if max_partition_bytes is None else {
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1"}
    return session_settings(spark, settings)
