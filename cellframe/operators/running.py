"""Running rows: one output row per cell, carrying the newest value so far."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import VERSION
from .ordered import scan


def running_row(cells: DataFrame, names: Mapping[str, str], *, by: Sequence[str] = ("row_key",),
                order: Sequence[str] = VERSION, chunks: int | None = None) -> DataFrame:
    """Each cell with the most recently seen value of every named qualifier.

    The scan runs per ``by`` group in ``order``, which must be unique within a group.
    Groups and order are cut into ``chunks`` ranges of about equal size, by default as
    many as the data needs, so a group of any size spreads over as many tasks as its
    rows fill.
    """
    columns = list(names.values())
    kept = [c for c in cells.columns if c not in columns]
    seen = cells.select(*kept, *[
        F.when(F.lower("qualifier") == q.lower(), F.col("value")).alias(t) for q, t in names.items()])
    return scan(seen, by, order, fill=columns, chunks=chunks)
