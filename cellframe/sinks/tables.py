"""External tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..model import ExportSpec
from ..sql import name_sql, text_sql


def table_name(name: str, prefix: str = "") -> str:
    return f"{prefix}{name}".lower()


def _quoted(name: str) -> str:
    return ".".join(name_sql(part) for part in name.split("."))


def create_table_sql(spec: ExportSpec, location: str, partition: str = "dt", prefix: str = "") -> str:
    """The statement that declares a spec's table, partitioned by one text column."""
    columns = ", ".join(f"{name_sql(c.target)} {c.spark_type.simpleString()}" for c in spec.columns)
    return (
        f"CREATE TABLE IF NOT EXISTS {_quoted(table_name(spec.table, prefix))} "
        f"({columns}, {name_sql(partition)} string) USING ORC "
        f"PARTITIONED BY ({name_sql(partition)}) LOCATION {text_sql(location)}")


def create_table(spark: SparkSession, spec: ExportSpec, location: str, partition: str = "dt",
                 prefix: str = "") -> str:
    """Declare the table unless it exists; gives its name."""
    spark.sql(create_table_sql(spec, location, partition, prefix))
    return table_name(spec.table, prefix)


def partition_location(spark: SparkSession, table: str, partition: str, label: str) -> str | None:
    """Where one partition of a table lies now; ``None`` if the table has no such partition."""
    target = f"PARTITION ({name_sql(partition)} = {text_sql(label)})"
    if spark.sql(f"SHOW PARTITIONS {_quoted(table)} {target}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)} {target}").where("col_name = 'Location'")
    return described.first()["data_type"]


def replace_partition(spark: SparkSession, table: str, partition: str, label: str, path: str) -> str | None:
    """Point one partition of a table at a directory, new or not; gives the old directory.

    An existing partition is moved by one statement, so readers find the old rows or the
    new ones, never none.
    """
    target = f"PARTITION ({name_sql(partition)} = {text_sql(label)})"
    old = partition_location(spark, table, partition, label)
    how = f"ADD {target} LOCATION" if old is None else f"{target} SET LOCATION"
    spark.sql(f"ALTER TABLE {_quoted(table)} {how} {text_sql(path)}")
    spark.sql(f"REFRESH TABLE {_quoted(table)}")
    return old
