"""Two-input operators: tagged union, merges by key and the inner join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import java_split, label, or_empty, zip_to_map
from .select import conform, drop_columns
from .skew import hot_keys, key_hash, spread_number


def tagged_union(sides: Mapping[str, DataFrame], tag: str = "type") -> DataFrame:
    """All rows of all inputs, with the input's name; absent columns are NULL."""
    union = None
    for name, df in sides.items():
        tagged = df.withColumn(tag, F.lit(name))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    return union


def merge_by_key(info: DataFrame, score: DataFrame, key: str, *, name: str, score_column: str,
                 info_order: Sequence[str], score_order: Sequence[str]) -> DataFrame:
    """One row per key of either input: key, ``name_type_score`` label and score.

    The last record of each side counts. ``type`` is ``score`` if the key has a
    score record, else ``info``; a missing name is ``''`` and a missing score 0.
    Both inputs meet in one aggregation, so the data is shuffled once and a key's
    duplicates are already reduced by then.
    """
    left = info.select(key, F.col(name).alias("_name"), F.struct(*info_order).alias("_info"))
    right = score.select(key, F.col(score_column).alias("_score"), F.struct(*score_order).alias("_rank"))
    # A record's order column is NULL on the other side's rows, and max_by skips NULL order.
    merged = left.unionByName(right, allowMissingColumns=True).groupBy(key).agg(
        F.max_by("_name", "_info").alias("_name"),
        F.max_by("_score", "_rank").alias("_score"),
        F.when(F.count("_rank") > 0, "score").otherwise("info").alias("_type"))
    points = F.coalesce(F.col("_score"), F.lit(0))
    return merged.select(
        key, label(F.col("_name"), F.col("_type"), points).alias("label"), points.alias("score"))


def merge_as_map(left: DataFrame, right: DataFrame, left_names: Sequence[str],
                 right_names: Sequence[str], columns: Sequence[str], *, order: str = "position",
                 line: str = "value", sep: str = "\t", missing: str | None = None) -> DataFrame:
    """Untyped merge of delimited lines on their first field.

    Every line's fields are put under the side's names; the last line of each side
    counts and the right side wins for a shared name. ``columns`` are the output;
    what neither side has is NULL, or the ``missing`` text.
    """
    def fields(df: DataFrame, side: str) -> DataFrame:
        return df.select(java_split(F.col(line), sep).alias(side), F.col(order).alias(f"{side}_order"))

    both = fields(left, "_left").unionByName(fields(right, "_right"), allowMissingColumns=True)
    key = F.coalesce(F.get("_left", F.lit(0)), F.get("_right", F.lit(0)))
    last = both.groupBy(key.alias("_key")).agg(*[
        F.max_by(side, f"{side}_order").alias(side) for side in ("_left", "_right")])
    maps = last.select(zip_to_map(left_names, F.col("_left")).alias("_left"),
                       zip_to_map(right_names, F.col("_right")).alias("_right"))

    def pick(name: str):
        sides = [F.col(side)[name] for side, names in (("_right", right_names), ("_left", left_names))
                 if name in names]
        if missing is not None:
            sides.append(F.lit(missing))
        return F.coalesce(*sides).alias(name)

    return maps.select(*[pick(c) for c in columns])


def override_columns(left: Sequence[str], right: Sequence[str], key: Sequence[str]) -> list[tuple[str, str]]:
    """``(side, column)`` of a merged row; the right side wins for a shared name."""
    shared = [("r" if c in right and c not in key else "l", c) for c in left]
    return shared + [("r", c) for c in right if c not in left]


def inner_join(left: DataFrame, right: DataFrame, key: Sequence[str], *,
               schema: T.StructType | None = None, without: Sequence[str] = ("dt",),
               text: bool = False, skew: str = "auto", hot_rows: int | None = None) -> DataFrame:
    """Every pair of records with equal keys, as one merged row each.

    Columns named in ``without`` are left out, the right side wins for a shared
    name, ``schema`` selects the output columns, and ``text`` renders every value
    as text with ``''`` for NULL.

    ``skew='auto'`` leaves large keys to adaptive execution, which splits their
    partitions while running, and salts them where that is switched off; ``'salt'``
    and ``'none'`` force one way. Neither side is broadcast: Spark judges it by its bytes
    in files, and a few MB of well-compressed ORC are millions of rows in the driver.
    """
    left, right = drop_columns(left, *without), drop_columns(right, *without)
    picked = override_columns(left.columns, right.columns, key)
    on = list(key)
    if skew == "salt" or (skew == "auto" and not _adaptive_skew_join(left)):
        left, right = _salted(left, right, on, hot_rows)
        on += ["_a", "_b"]
    elif skew not in ("auto", "none"):
        raise ValueError(f"skew must be 'auto', 'salt' or 'none', not {skew!r}")
    joined = left.alias("l").join(right.alias("r").hint("merge"), on, "inner")
    rows = joined.select(*[F.col(c) if c in key else F.col(f"{side}.`{c}`") for side, c in picked])
    if schema is not None:
        rows = conform(rows, schema)
    return rows.select(*[or_empty(F.col(f"`{c}`")).alias(c) for c in rows.columns]) if text else rows


def _adaptive_skew_join(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    switches = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(conf.get(s) == "true" for s in switches)


def _salted(left: DataFrame, right: DataFrame, key: list[str], hot_rows: int | None):
    """Both sides with salt columns ``_a`` and ``_b``, 0 for ordinary keys.

    ``_a`` spreads keys that are hot on the left: a left row draws one salt and a
    right row is repeated for each. ``_b`` does the same for the right.
    """
    hot_left = hot_keys(left, key, hot_rows).toDF("_hot_left", "_salts_left")
    hot_right = hot_keys(right, key, hot_rows).toDF("_hot_right", "_salts_right")

    def prepare(df: DataFrame, own: str, own_salt: str, other: str, other_salt: str) -> DataFrame:
        marked = (
            df.withColumn("_spread", spread_number(df))
            .join(hot_left, key_hash(key) == F.col("_hot_left"), "left")
            .join(hot_right, key_hash(key) == F.col("_hot_right"), "left"))
        every = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return marked.select(
            *[F.col(f"`{c}`") for c in df.columns],
            F.pmod("_spread", F.coalesce(own, F.lit(1))).alias(own_salt),
            F.explode(every).alias(other_salt))

    return (prepare(left, "_salts_left", "_a", "_salts_right", "_b"),
            prepare(right, "_salts_right", "_b", "_salts_left", "_a"))
