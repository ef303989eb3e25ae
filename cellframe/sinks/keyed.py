"""Cell tables kept in the order of their row keys, for assembly without a shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import VERSION
from ..operators.skew import hot_keys, key_hash
from ..session import tasks_for

# With this setting Spark also uses the order of keys inside a bucket's file, so the
# aggregation of a bucket needs no sort. Set it for the job that reads the table.
KEY_ORDER = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


@dataclass(frozen=True)
class KeyedCells:
    """The cells of a table: ``cells`` by buckets of the key, ``large`` those of its largest keys.

    No key is in both. ``large`` is ``None`` if no key fills more than a bucket.
    """

    cells: DataFrame
    large: DataFrame | None
    key: str


def _large(table: str) -> str:
    return f"{table}_large"


def write_keyed_cells(cells: DataFrame, table: str, path: str, buckets: int | None = None, *,
                      key: str = "row_key", bucket_rows: int | None = None) -> None:
    """Save cells as two tables in the session catalog, their files below ``path``.

    Each of ``buckets`` files (by default as many as the data needs) holds all cells of its
    row keys, sorted by key and version. A key with more than ``bucket_rows`` cells, by
    default a bucket's share of all, would make one task as long as itself; there are never
    more such keys than buckets, and their cells go to a table of their own, which any
    number of tasks reads. Tables of these names are replaced.
    """
    buckets = buckets or tasks_for(cells)
    if bucket_rows is None:
        bucket_rows = max(1, -(-cells.count() // buckets))
    large = hot_keys(cells, [key], bucket_rows).select("_hot")
    hashed = cells.withColumn("_hot", key_hash([key]))
    order = [key, *(c for c in VERSION if c in cells.columns)]
    small = hashed.join(F.broadcast(large), "_hot", "left_anti").drop("_hot")
    (small.repartition(buckets, key).sortWithinPartitions(*order).write.mode("overwrite").format("parquet")
        .bucketBy(buckets, key).sortBy(*order).option("path", f"{path.rstrip('/')}/keyed").saveAsTable(table))
    (hashed.join(F.broadcast(large), "_hot", "left_semi").drop("_hot").write.mode("overwrite").format("parquet")
        .option("path", f"{path.rstrip('/')}/large").saveAsTable(_large(table)))


def read_keyed_cells(spark: SparkSession, table: str, key: str = "row_key") -> KeyedCells:
    large = spark.table(_large(table))
    return KeyedCells(spark.table(table), None if large.isEmpty() else large, key)
