"""Scans along an order: running values and numbers within groups of any size.

Rows are dealt over tasks by ranges of group and order, so they move once and a group of
any size spreads over as many tasks as its rows fill. Each range is scanned on its own.
What goes on from range to range is one row per range: the last group and what is known of
it. These rows are scanned in two levels, first within blocks of ranges, then from block to
block, and what a range inherits is joined to the rows of its first group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..scratch import stored
from ..session import tasks_for

# Ranges that are scanned together before blocks of them are.
BLOCK = 1024

# Up to so many ranges, what they inherit (a row each) is broadcast; above, Spark chooses.
BROADCAST_RANGES = 4096

_FIRST, _LAST = 1, 2


def _group_starts(batch: pa.RecordBatch, by: Sequence[str], before: list | None) -> np.ndarray:
    """Which rows begin a group; ``before`` are the group columns of the row ahead of the batch."""
    starts = np.zeros(batch.num_rows, bool)
    for k, name in enumerate(by):
        column = batch.column(name)
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts[1:] |= codes[1:] != codes[:-1]
        if before is not None:
            now = column[0].as_py()
            starts[0] |= not (now == before[k] or (now != now and before[k] != before[k]))
    return starts | ((np.arange(batch.num_rows) == 0) & (before is None))


class _Range:
    """The scan of one range, batch by batch."""

    def __init__(self, by: Sequence[str], fill: Sequence[str]):
        self.by, self.fill = by, fill
        self.before, self.known, self.count, self.head = None, {}, 0, True

    def batch(self, batch: pa.RecordBatch) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
        """The filled columns, each row's number in its group, and whether it is in the first group."""
        n, first = batch.num_rows, self.before is None
        starts, places = _group_starts(batch, self.by, self.before), np.arange(batch.num_rows)
        # Where a row's group begins; -1 for a group that began in an earlier batch.
        begin = np.maximum.accumulate(np.where(starts, places, -1))
        filled = {}
        for name in self.fill:
            column = batch.column(name)
            seen = np.maximum.accumulate(np.where(column.is_valid().to_numpy(zero_copy_only=False), places, -1))
            held = pa.concat_arrays([self.known.get(name, pa.nulls(1, column.type)), column])
            missing = (seen < begin) & (begin >= 0)
            filled[name] = held.take(pa.array(np.where(missing, 0, seen + 1), mask=missing))
            self.known[name] = filled[name].slice(n - 1, 1)
        numbers = np.where(begin < 0, self.count + places + 1, places - begin + 1)
        self.count = int(numbers[-1])
        later = starts.copy()
        later[0] &= not first
        head = self.head & ~np.logical_or.accumulate(later)
        self.head = bool(head[-1])
        self.before = [batch.column(c)[n - 1].as_py() for c in self.by]
        return filled, numbers, head


def _scanning(by: Sequence[str], fill: Sequence[str], names: Sequence[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = _Range(by, fill), None

        def made(batch: pa.RecordBatch, filled, numbers, head, edge) -> pa.RecordBatch:
            columns = [filled[c] if c in filled else batch.column(c) for c in names]
            return pa.RecordBatch.from_arrays(
                [*columns, batch.column("_chunk"), pa.array(numbers, pa.int64()), pa.array(head), pa.array(edge, pa.int32())], schema=schema)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            edge = np.zeros(batch.num_rows, np.int32)
            edge[0] = _FIRST * (state.before is None)
            if held is not None:
                yield made(*held)
            held = (batch, *state.batch(batch), edge)
        if held is not None:
            held[-1][-1] |= _LAST
            yield made(*held)

    return run


def _inherited(edges: DataFrame, by: Sequence[str], fill: Sequence[str], chunks: int) -> DataFrame:
    """``_to, _f0.., _before``: what the first group of each range knows from earlier ranges.

    ``edges`` are the first and the last row of every range. Within a block of ranges the
    last rows are scanned by group; where there are several blocks, the blocks' own last
    rows are, too. No window is over more rows than a block has ranges, or than there are
    blocks.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    known = [f"_f{i}" for i in range(len(fill))]

    def entry(edge: int, kind: int, values: Sequence[Column], before: Column) -> Column:
        return F.when(F.col("_edge").bitwiseAND(edge) > 0, F.struct(
            F.lit(kind).alias("_kind"), *[v.alias(k) for v, k in zip(values, known)], before.cast("bigint").alias("_before")))

    needs = entry(_FIRST, 0, [F.lit(None).cast(edges.schema[c].dataType) for c in fill], F.lit(0))
    ends = entry(_LAST, 1, [F.col(f"`{c}`") for c in fill], F.col("_number"))
    both = edges.select(
        F.floor(F.col("_chunk") / BLOCK).alias("_block"), "_chunk", *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)],
        F.explode(F.array_compact(F.array(needs, ends))).alias("_e")).select("_block", "_chunk", *keys, "_e.*")

    def over(column: str, window, what) -> Column:
        return what(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def latest(c: str) -> Column:
        return F.last(c, ignorenulls=True)

    inside = Window.partitionBy("_block", *keys).orderBy("_chunk", "_kind")
    near = both.select("_block", "_chunk", "_kind", *keys, *[over(k, inside, latest).alias(k) for k in known],
                       over("_before", inside, F.sum).alias("_before")).where("_kind = 0")
    if chunks <= BLOCK:
        return near.select(F.col("_chunk").alias("_to"), *known, F.coalesce("_before", F.lit(0)).alias("_before"))
    # First rows count nothing here, but give their block a row for every group it inherits.
    whole = both.groupBy("_block", *keys).agg(
        *[F.max_by(k, F.when(F.col(k).isNotNull(), F.col("_chunk"))).alias(k) for k in known], F.sum("_before").alias("_before"))
    across = Window.partitionBy(*keys).orderBy("_block")
    far = whole.select(F.col("_block").alias("_far"), *[F.col(k).alias(f"{k}_far") for k in keys],
                       *[over(k, across, latest).alias(f"{k}_far") for k in known],
                       over("_before", across, F.sum).alias("_before_far"))
    on = F.col("_block") == F.col("_far")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_far"))
    return near.join(far, on, "left").select(
        F.col("_chunk").alias("_to"), *[F.coalesce(k, f"{k}_far").alias(k) for k in known],
        (F.coalesce("_before", F.lit(0)) + F.coalesce("_before_far", F.lit(0))).alias("_before"))


def scan(df: DataFrame, by: Sequence[str], order: Sequence[str], *, fill: Sequence[str] = (),
         number: str | None = None, chunks: int | None = None) -> DataFrame:
    """Rows with the newest value so far of each ``fill`` column, and their ``number`` from 1.

    Both are counted per ``by`` group in ``order``, which must be unique within a group for
    a defined result; NULL is a group like others. ``by`` takes columns of plain types. Rows
    are cut into ``chunks`` ranges, by default as many as the data needs.
    """
    by, order, fill, names = list(by), list(order), list(fill), df.columns
    keys = [F.col(f"`{c}`") for c in (*by, *order)]
    chunks = chunks or tasks_for(df)
    ranged = df.repartitionByRange(chunks, *keys).sortWithinPartitions(*keys)
    numbered = ranged.withColumn("_chunk", F.spark_partition_id())
    schema = T.StructType([*df.schema.fields, T.StructField("_chunk", T.IntegerType()), T.StructField("_number", T.LongType()),
                           T.StructField("_head", T.BooleanType()), T.StructField("_edge", T.IntegerType())])
    local = numbered.mapInArrow(_scanning(by, fill, names, to_arrow_schema(schema)), schema)
    if df.sparkSession.conf.get("spark.sql.exchange.reuse") != "true":
        local = stored(local, "ranges")  # both uses below must see the same ranges
    carried = _inherited(local.where("_edge > 0"), by, fill, chunks)
    if chunks <= BROADCAST_RANGES:
        carried = F.broadcast(carried)
    joined = local.join(carried, F.col("_head") & (F.col("_chunk") == F.col("_to")), "left")
    rows = [F.coalesce(f"`{c}`", f"_f{fill.index(c)}").alias(c) if c in fill else F.col(f"`{c}`") for c in names]
    if number is not None:
        rows.append((F.col("_number") + F.coalesce("_before", F.lit(0))).alias(number))
    return joined.select(*rows)
