"""Best-fit packing of tokenised documents into sequences of bounded length.

Documents longer than a sequence are cut: the first piece takes what is over, the
others fill a sequence each. Partitions then pack their pieces best-fit, largest first,
into bins. Bins that are full, or whose room is too small for any bin that is at most
half full, are final. The others go on as items: a tree of rounds brings the bins of
``FAN`` groups together and packs them best-fit again, until one group is left.

After best-fit at most one bin of a group is at most half full, so a round that starts
from G groups places at most G such bins. G bins of each fill are therefore enough for
them, and the rest are final too: a group never holds more than G bins of a fill.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, stored, table, texts
from .tokens import encoder

LENGTH, END = 2048, 0
FAN = 16


def best_fit(sizes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The bin and offset of each item: largest first, into the fullest bin with room.

    Bins are numbered by their first item's place in the input; ties go to the lower
    place. A bit per amount of room tells which amounts some open bin has.
    """
    sizes = np.asarray(sizes, np.int64)
    bins, offsets = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(length + 1)]
    mask = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = mask >> size
        if found:
            left = size + (found & -found).bit_length() - 1
            target = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
            bins[item], offsets[item] = target, length - left
        else:
            target, left = item, length
        left -= size
        if left:
            room[left].append(target)
            mask |= 1 << left
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of the pieces of every row with an id.

    NULL counts as empty; every document ends with the id ``end``.
    """
    def cut(batches):
        known = encoder(tokenizer)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part, rows = batch.iloc[low:low + 256], []
                for doc, ids in zip(part["doc_id"], known.encode(part["text"].tolist()), strict=True):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    first = len(ids) % length or length
                    for piece, start in enumerate([0, *range(first, len(ids), length)]):
                        data = ids[start:start + (length if piece else first)].tobytes()
                        rows.append((doc, piece, start, len(data) // 4, zlib.crc32(data), data)[:6 if with_ids else 5])
                yield pd.DataFrame(rows, columns=columns)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = texts(docs)
    return docs.mapInPandas(cut, schema)


def _packed_locally(length: int):
    """Best-fit within a partition, at most ``1 << 20`` pieces at a time."""
    def pack(batches):
        task, done, kept, rows = TaskContext.get().partitionId(), 0, [], 0

        def block():
            frame = pd.concat(kept, ignore_index=True)
            bins, offsets = best_fit(frame["length"], length)
            return frame.assign(bin=(task << 36) + done + bins, offset=offsets)

        for batch in batches:
            kept.append(batch)
            rows += len(batch)
            if rows >= 1 << 20:
                yield block()
                done, kept, rows = done + rows, [], 0
        if rows:
            yield block()
    return pack


def _round(length: int):
    """Best-fit of the bins of one group."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["fill", "bin"], ascending=[False, True], kind="stable", ignore_index=True)
        bins, offsets = best_fit(group["fill"], length)
        return pd.DataFrame({"bin": group["bin"], "root": group["bin"].to_numpy()[bins], "shift": offsets,
                             "fill": group["fill"], "team": group["team"]})
    return pack


def pack_pieces(pieces: DataFrame, length: int = LENGTH, fan: int = FAN) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. Extra columns stay; an empty table stays empty."""
    kept = pieces.schema.simpleString()[len("struct<"):-1]
    placed = stored(pieces.mapInPandas(_packed_locally(length), f"{kept}, bin:bigint, offset:bigint"), "placed")
    bins = placed.groupBy("bin").agg(F.sum("length").alias("fill")).where(f"fill < {length}")
    pool = stored(bins.withColumn("team", F.shiftright("bin", 36)), "bins")
    moves = None
    while True:
        small = pool.where(f"fill <= {length // 2}").agg(F.count(F.lit(1)).alias("n"), F.min("fill").alias("least")).first()
        teams = pool.agg(F.count_distinct("team").alias("n")).first()["n"]
        if small["n"] < 2 and (moves is not None or not small["n"]) or teams < 2:
            break
        # Bins without room for the smallest are final, and of each fill all but as many as can be needed.
        spare = Window.partitionBy("team", "fill").orderBy("bin")
        useful = pool.where(f"fill <= {length - small['least']}").withColumn("nth", F.row_number().over(spare)).where(
            (F.col("nth") <= small["n"]) | (F.col("fill") <= length // 2)).drop("nth")
        merged = stored(useful.withColumn("team", F.floor(F.col("team") / fan)).groupBy("team").applyInPandas(
            _round(length), "bin long, root long, shift long, fill long, team long"), "round")
        step = merged.select("bin", "root", "shift")
        if moves is None:
            moves = step
        else:
            moves = moves.join(step.select(F.col("bin").alias("root"), F.col("root").alias("top"), F.col("shift").alias("more")), "root", "left").select(
                "bin", F.coalesce("top", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            ).unionByName(step.join(moves.select("bin"), "bin", "left_anti"))
        moves = stored(moves, "moves")
        pool = stored(merged.groupBy(F.col("root").alias("bin")).agg(F.sum("fill").alias("fill"), F.first("team").alias("team")), "bins")
    out = placed.withColumn("sequence_id", F.col("bin"))
    if moves is not None:
        moved = moves.where("bin <> root OR shift <> 0")
        out = placed.join(moved, "bin", "left").withColumn("sequence_id", F.coalesce("root", "bin")).withColumn(
            "offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
    return out.select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """Where every piece of every document lies in the packed sequences.

    Rows that repeat an id are documents of their own; rows without an id are left out.
    """
    # Written first, so that a task never runs the tokenizer and the packing side by side.
    return pack_pieces(stored(token_pieces(docs, tokenizer, length, end, with_ids), "pieces"), length)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
