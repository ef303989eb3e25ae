"""Small frames and comparisons for the tests."""

from cellframe import CELL


def cells_frame(spark, cells, partitions=3):
    """Cells from ``(row_key, qualifier, text, ts, seq)`` tuples, in family ``f``."""
    rows = [(k, "f", q, None if v is None else bytearray(v.encode()), ts, seq) for k, q, v, ts, seq in cells]
    return spark.createDataFrame(rows, CELL).repartition(partitions)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
