"""From cells to rows.

Assembly is one aggregation per row key. Spark reduces the cells inside every
scan task before it shuffles them, so a row key that holds a large share of all
cells reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import decode
from ..functions.text import or_empty
from ..model import VERSION, ColumnSpec
from ..session import tasks_for
from ..sinks.keyed import KeyedCells
from ..sql import name_sql, text_sql
from .ordered import scan
from .select import map_columns, pick_qualifiers, require, require_nonempty, with_partition

# The column of what did not decode, in assembly with ``on_error="reject"``.
REJECTS = "rejects"

# Above this many columns, rows are put together from a map instead of from one
# filtered aggregate per column, whose cost grows with columns times cells.
WIDE_COLUMNS = 24


def _version(order: Sequence[str]) -> str:
    return f"struct({', '.join(name_sql(c) for c in order)})"


def _newest(mapped: DataFrame, key: str, targets: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key with the newest raw value of every target."""
    return mapped.groupBy(key).agg(*[
        F.expr(f"max_by(value, {_version(order)}) FILTER (WHERE slot = {i})").alias(t)
        for i, t in enumerate(targets)
    ])


def _typed(raw: str, is_bytes: bool, spec: ColumnSpec, on_error: str, name: str) -> Column:
    rejecting = on_error == "reject"
    if is_bytes:
        return decode(raw, spec.spark_type, spec.encoding, "null" if rejecting else on_error, name)
    return F.col(raw).try_cast(spec.spark_type) if rejecting else F.col(raw).cast(spec.spark_type)


def _rejected(raw: Column, typed: Column, name: Column) -> Column:
    """A value that is present but has no typed form, with its column's name; NULL otherwise."""
    return F.when(raw.isNotNull() & typed.isNull(), F.struct(name.alias("column"), raw.alias("value")))


def _narrow_rows(mapped: DataFrame, columns: Sequence[ColumnSpec], key: str, order: Sequence[str],
                 is_bytes: bool, on_error: str) -> DataFrame:
    names = [f"_c{i}" for i in range(len(columns))]
    raw = _newest(mapped, key, names, order)
    typed = [_typed(n, is_bytes, c, on_error, text_sql(c.target)) for n, c in zip(names, columns)]
    more = [] if on_error != "reject" else [F.array_compact(F.array(*[
        _rejected(F.col(n), t, F.lit(c.target)) for n, t, c in zip(names, typed, columns)])).alias(REJECTS)]
    return raw.select(F.col(key).alias("_key"), *[t.alias(c.target) for t, c in zip(typed, columns)], *more)


def _wide_rows(mapped: DataFrame, columns: Sequence[ColumnSpec], key: str, order: Sequence[str],
               is_bytes: bool, on_error: str) -> DataFrame:
    """The same rows for many columns.

    First one value per key and slot, which also spreads a large row key over many
    tasks. These are decoded by one expression per declared type rather than per
    column; then a row is a map with at most one entry per target column.
    """
    newest = mapped.groupBy(key, "slot").agg(F.expr(f"max_by(value, {_version(order)})").alias("value"))
    kinds = list(dict.fromkeys((c.spark_type, c.encoding) for c in columns))
    slots = {k: [i for i, c in enumerate(columns) if (c.spark_type, c.encoding) == k] for k in kinds}
    name = f"element_at(array({', '.join(text_sql(c.target) for c in columns)}), slot + 1)"
    typed = newest.select(key, "slot", "value", *[
        F.when(F.col("slot").isin(slots[k]), _typed("value", is_bytes, columns[slots[k][0]], on_error, name))
        .alias(f"_t{j}") for j, k in enumerate(kinds)])
    entry = F.struct("slot", F.struct(*[f"_t{j}" for j in range(len(kinds))]))
    lists = [F.map_from_entries(F.collect_list(entry)).alias("_by_slot")]
    if on_error == "reject":
        bad = _rejected(F.col("value"), F.coalesce(*[F.col(f"_t{j}").cast("string") for j in range(len(kinds))]), F.expr(name))
        lists.append(F.transform(F.sort_array(F.collect_list(F.when(bad.isNotNull(), F.struct("slot", bad.alias("bad"))))),
                                 lambda x: x["bad"]).alias(REJECTS))
    by_slot = typed.groupBy(key).agg(*lists)
    return by_slot.select(F.col(key).alias("_key"), *[
        F.try_element_at("_by_slot", F.lit(i))[f"_t{kinds.index((c.spark_type, c.encoding))}"].alias(c.target)
        for i, c in enumerate(columns)], *([REJECTS] if on_error == "reject" else []))


def assemble(cells: DataFrame, columns: Sequence[ColumnSpec], *, key: str = "row_key",
             order: Sequence[str] = VERSION, on_error: str = "fail",
             partition: tuple[str, str] | None = None, keep_key: bool = True,
             wide: bool | None = None) -> DataFrame:
    """One typed row per row key that has at least one mapped cell.

    The newest version by ``order`` wins; a missing column is NULL. Values are
    decoded after the aggregation, once per output field, if they are bytes, and
    cast otherwise. ``partition`` adds a constant ``(name, label)`` column.

    A value that does not decode ends the job, or with ``on_error='null'`` is NULL. With
    ``'reject'`` it is NULL, too, and ``rejects`` lists the row's ``column, value`` pairs of
    this kind, in the order of the columns.
    """
    wide = len(columns) > WIDE_COLUMNS if wide is None else wide
    is_bytes = isinstance(cells.schema["value"].dataType, T.BinaryType)
    build = _wide_rows if wide else _narrow_rows
    rows = build(map_columns(cells, columns), columns, key, order, is_bytes, on_error)
    rows = rows.withColumnRenamed("_key", key) if keep_key else rows.drop("_key")
    return rows if partition is None else with_partition(rows, *partition)


def assemble_keyed(keyed: KeyedCells, columns: Sequence[ColumnSpec], *, order: Sequence[str] = VERSION,
                   on_error: str = "fail", partition: tuple[str, str] | None = None, keep_key: bool = True,
                   wide: bool | None = None) -> DataFrame:
    """The rows of ``assemble`` from a table kept by row key.

    All cells of a key are in one bucket, so buckets are assembled where they are read:
    nothing is shuffled. Keys that are larger than a bucket are assembled as elsewhere, from
    one partial row per scan task.
    """
    def rows(cells: DataFrame) -> DataFrame:
        return assemble(cells, columns, key=keyed.key, order=order, on_error=on_error, partition=partition,
                        keep_key=keep_key, wide=wide)

    return rows(keyed.cells) if keyed.large is None else rows(keyed.cells).unionByName(rows(keyed.large))


def assemble_strings(cells: DataFrame, names: Mapping[str, str], required: str | None = None, *,
                     key: str = "row_key", order: Sequence[str] = VERSION) -> DataFrame:
    """Text rows from qualifiers matched in any letter case.

    ``names`` maps a qualifier to its column; rows without the ``required``
    column are left out.
    """
    mapped = pick_qualifiers(cells, names)
    rows = _newest(mapped, key, list(names.values()), order)
    rows = rows.select(key, *[F.col(t).cast("string").alias(t) for t in names.values()])
    return rows if required is None else require(rows, required)


def assemble_tsv(cells: DataFrame, key_qualifier: str, value_qualifier: str, *,
                 key: str = "row_key", order: Sequence[str] = VERSION) -> DataFrame:
    """One ``key<TAB>value`` line per row whose key text is not empty."""
    names = {key_qualifier: "_key", value_qualifier: "_value"}
    rows = require_nonempty(assemble_strings(cells, names, key=key, order=order), "_key")
    return rows.select(F.concat_ws("\t", "_key", or_empty(F.col("_value"))).alias("line"))


def _newest_cells(cells: DataFrame, qualifiers: Sequence[str] | None, key: str, order: Sequence[str]) -> DataFrame:
    """``key`` and ``cell``: the newest version of each cell of a row, as it stands in lists.

    Version columns lead the struct, so sorting by it sorts by version.
    """
    wanted = cells if qualifiers is None else cells.where(F.lower("qualifier").isin([q.lower() for q in qualifiers]))
    others = [c for c in ("value", *order) if c in cells.columns]
    newest = wanted.groupBy(key, "family", "qualifier").agg(
        F.max_by(F.struct(*others), F.expr(_version(order))).alias("cell"))
    entry = F.struct(*[F.col(f"cell.{c}").alias(c) for c in order],
                     "family", "qualifier", F.col("cell.value").alias("value"))
    return newest.select(key, entry.alias("cell"))


def read_rows(cells: DataFrame, qualifiers: Sequence[str] | None = None, *, key: str = "row_key",
              order: Sequence[str] = VERSION) -> DataFrame:
    """Each row key with the list of its newest cells, sorted by version.

    Older versions are dropped before the lists are built, so a list has one cell per
    family and qualifier of its row, however many versions there are. ``qualifiers``,
    in any letter case, keeps only those. Rows without bound on their qualifiers need that,
    or ``read_row_pieces``.
    """
    newest = _newest_cells(cells, qualifiers, key, order)
    return newest.groupBy(key).agg(F.sort_array(F.collect_list("cell")).alias("cells"))


def read_row_pieces(cells: DataFrame, piece_cells: int, qualifiers: Sequence[str] | None = None, *,
                    key: str = "row_key", order: Sequence[str] = VERSION, chunks: int | None = None) -> DataFrame:
    """Rows of any size as pieces: ``key, piece, cells`` with at most ``piece_cells`` cells each.

    Pieces are numbered from 0 in the order of versions, so the lists of a row's pieces one
    after another are the list of ``read_rows``. A row's cells are numbered where ranges of
    keys and versions lie, not in one task; every list but a row's last one is full.
    """
    newest = _newest_cells(cells, qualifiers, key, order)
    place = [f"_{i}" for i in range(len(order) + 2)]
    flat = newest.select(key, "cell", *[F.col(f"cell.{c}").alias(n) for c, n in zip((*order, "family", "qualifier"), place)])
    numbered = scan(flat, [key], place, number="_number", chunks=chunks)
    piece = F.floor((F.col("_number") - 1) / piece_cells).cast("bigint").alias("piece")
    return numbered.select(key, piece, "cell").groupBy(key, "piece").agg(F.sort_array(F.collect_list("cell")).alias("cells"))


def _last_match(qualifier: str) -> Column:
    """The last cell of a list with this qualifier, in any letter case."""
    return F.try_element_at(F.filter("cells", lambda c: F.lower(c["qualifier"]) == qualifier.lower()), F.lit(-1))


def assemble_from_rows(rows: DataFrame, names: Mapping[str, str], *, key: str = "row_key",
                       as_text: bool = True) -> DataFrame:
    """Columns out of already grouped rows, without any shuffle.

    ``cells`` must be sorted by version; the last match of a qualifier, in any
    letter case, is the value.
    """
    def last_value(qualifier: str) -> Column:
        value = _last_match(qualifier)["value"]
        return value.cast("string") if as_text else value

    return rows.select(key, *[last_value(q).alias(t) for q, t in names.items()])


def assemble_from_pieces(pieces: DataFrame, names: Mapping[str, str], *, key: str = "row_key",
                         as_text: bool = True) -> DataFrame:
    """The rows of ``assemble_from_rows`` out of pieces of rows.

    Every piece is reduced to one value per column where it lies; the match in a row's
    highest piece counts. Only these values are shuffled, combined in each task first.
    """
    found = pieces.select(key, "piece", *[_last_match(q).alias(f"_c{i}") for i, q in enumerate(names)])
    rows = found.groupBy(key).agg(*[
        F.max_by(F.col(f"_c{i}")["value"], F.when(F.col(f"_c{i}").isNotNull(), F.col("piece"))).alias(f"_c{i}")
        for i in range(len(names))])
    return rows.select(key, *[
        (F.col(f"_c{i}").cast("string") if as_text else F.col(f"_c{i}")).alias(t) for i, t in enumerate(names.values())])


def dump_pairs(cells: DataFrame, num_files: int | None = None, *, key: str = "row_key") -> DataFrame:
    """Every cell's key, qualifier and value text, ordered by key and version in each file.

    Files hold ranges of keys and versions of about equal size, so the cells of a key
    are in one file or in neighbouring ones.
    """
    order = [key, *(c for c in VERSION if c in cells.columns), "qualifier"]
    ranged = cells.repartitionByRange(num_files or tasks_for(cells), *order)
    return ranged.sortWithinPartitions(*order).select(
        key, "qualifier", F.col("value").cast("string").alias("value"))
