"""Text expressions used by the joins, the word count and the manifest jobs.

Every function takes and returns a ``Column`` built from Spark's own functions,
so it stays inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(text: Column, sep: str) -> Column:
    """Split on one character; trailing empty parts are dropped.

    Leading and inner empty parts stay, and the empty text is one empty part.
    """
    if len(sep) != 1:
        raise ValueError("the separator must be a single character")
    trimmed = F.rtrim(text, F.lit(sep))
    only_separators = (trimmed == "") & (text != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(trimmed, re.escape(sep)))


def label(*parts: Column, sep: str = "_") -> Column:
    """Parts joined with ``_``; a missing part counts as empty text."""
    return F.concat_ws(sep, *[or_empty(p) for p in parts])


def or_empty(value: Column) -> Column:
    """The value as text, with the empty text for NULL."""
    return F.coalesce(value.cast("string"), F.lit(""))


def hex_pairs(value: Column) -> Column:
    """Bytes as lower-case hex pairs separated by blanks: ``61 62 63``."""
    return F.rtrim(F.regexp_replace(F.lower(F.hex(value)), "(..)", "$1 "))


def partition_label(moment: Column) -> Column:
    """A timestamp as the 17 digits ``yyyyMMddHHmmssSSS``."""
    return F.date_format(moment, "yyyyMMddHHmmssSSS")


def record_to_text(columns: Sequence[str]) -> Column:
    """Named columns as ``name=value`` pairs joined by commas."""
    return F.concat_ws(",", *[F.concat(F.lit(f"{c}="), or_empty(F.col(c))) for c in columns])


def text_to_record(text: Column) -> Column:
    """The map behind ``name=value,…``; a name without a value maps to ``''``."""
    pairs = F.str_to_map(text, F.lit(","), F.lit("="))
    return F.transform_values(pairs, lambda _, v: F.coalesce(v, F.lit("")))


def parse_int(text: Column, strict: bool = True) -> Column:
    """A signed decimal integer; anything else fails, or is NULL if not strict.

    Blanks around the digits are not accepted.
    """
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
    if not strict:
        return whole
    broken = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("int")
    return F.coalesce(whole, F.when(text.isNotNull(), broken))


def count_matches(text: Column, piece: str) -> Column:
    """How often a fixed piece of text occurs."""
    return F.regexp_count(text, F.lit(re.escape(piece)))


def flat_name(name: Column) -> Column:
    """``namespace:table`` as ``namespace_table``."""
    return F.replace(name, F.lit(":"), F.lit("_"))


def zip_to_map(names: Sequence[str], values: Column) -> Column:
    """Positional values under their names; missing trailing values have no entry."""
    keys = F.array(*[F.lit(n) for n in names])
    return F.map_from_arrays(F.slice(keys, 1, F.size(values)), values)


def key_text(row_key: Column) -> Column:
    """A row key's bytes read as UTF-8 text."""
    return row_key.cast("string")


def qualified_name(family: Column, qualifier: Column) -> Column:
    return F.concat_ws(":", family, qualifier)
