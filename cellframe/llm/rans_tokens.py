"""Token ids as binary files, coded with a static range asymmetric numeral system.

A file holds consecutive documents in ascending id. One frequency table, counted over
all ids of the file, is shared by its blocks. A block codes up to ``BLOCK`` ids in
``lanes`` interleaved 64-bit states, id ``i`` in lane ``i % lanes``, so that each step
codes one id per lane with array operations. Blocks are independent of one another.

    file:   MAGIC, table, blocks, index, trailer
    table:  zlib of (symbols, frequencies; 32-bit), bits of the total
    block:  states (64-bit), words (32-bit)
    index:  zlib of one checkpoint per block (place, first id, ids, lanes, words, crc32 of
            its bytes) and one row per document (id, number of ids)
    trailer: place of the index, crc32 of the index

A reader needs the table, the index and any one block to decode that block; checksums
tell damaged bytes. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, scratch_dir, stored, table, tasks_for, texts
from .files import fresh_file, open_file
from .tokens import encoder

END = 1
MAGIC = b"RANSIDS1"
BLOCK, LANES = 1 << 16, 512
FILE_IDS = 1 << 22
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_CHECKPOINT = np.dtype([("place", "<u8"), ("first", "<u8"), ("ids", "<u4"), ("lanes", "<u4"), ("words", "<u4"), ("crc", "<u4")])
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("ids", "<u8")])


class Table:
    """Symbols with frequencies that add up to ``1 << bits``."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray, bits: int):
        self.symbols, self.bits = symbols.astype(np.uint32), bits
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = np.append(0, np.cumsum(frequencies))[:-1].astype(np.uint64)

    @classmethod
    def counted(cls, ids: np.ndarray) -> Table:
        symbols, counts = np.unique(ids, return_counts=True)
        bits = max(16, int(len(symbols)).bit_length() + 2)
        total = 1 << bits
        scaled = np.maximum(1, counts.astype(np.float64) * (total / counts.sum())).astype(np.int64)
        over = int(scaled.sum()) - total
        for place in np.argsort(-scaled, kind="stable"):  # the largest take up what rounding left
            step = -over if over < 0 else -min(over, int(scaled[place]) - 1)
            scaled[place] += step
            over += step
            if not over:
                break
        return cls(symbols, scaled, bits)

    def pack(self) -> bytes:
        data = zlib.compress(self.symbols.astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes())
        return struct.pack("<III", self.bits, len(self.symbols), len(data)) + data

    @classmethod
    def read(cls, stream) -> Table:
        bits, n, size = struct.unpack("<III", stream.read(12))
        both = np.frombuffer(zlib.decompress(stream.read(size)), "<u4")
        return cls(both[:n], both[n:], bits)


def encode_block(ids: np.ndarray, table: Table) -> tuple[int, np.ndarray, np.ndarray]:
    """The lanes, final states and words of a block."""
    lanes = max(1, min(LANES, len(ids) // 64))
    which = np.searchsorted(table.symbols, ids)
    states, words = np.full(lanes, _LOW), []
    shift = np.uint64(table.bits)
    for start in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        now = which[start:start + lanes]
        frequency, x = table.frequencies[now], states[:len(now)]
        full = x >= frequency << np.uint64(63 - table.bits)
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> _32, x)
        quotient = x // frequency
        states[:len(now)] = (quotient << shift) + (x - quotient * frequency) + table.starts[now]
    return lanes, states.astype("<u8"), np.concatenate(words[::-1])


def decode_block(n: int, states: np.ndarray, words: np.ndarray, table: Table, slots: np.ndarray) -> np.ndarray:
    """The ``n`` ids of a block; ``slots`` gives the symbol number of every slot."""
    out, lanes, at = np.empty(n, np.uint32), len(states), 0
    states = states.astype(np.uint64)
    mask, shift = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
    for start in range(0, n, lanes):
        x = states[:min(lanes, n - start)]
        slot = x & mask
        which = slots[slot]
        out[start:start + len(x)] = table.symbols[which]
        x = table.frequencies[which] * (x >> shift) + slot - table.starts[which]
        low = np.flatnonzero(x < _LOW)
        x[low] = (x[low] << _32) | words[at:at + len(low)]
        at += len(low)
        states[:len(x)] = x
    return out


def write_file(stream, documents: list[tuple[int, int]], ids: np.ndarray) -> int:
    """Write one file; ``documents`` are (id, number of ids) in order. Gives its bytes."""
    table = Table.counted(ids)
    head = MAGIC + table.pack()
    stream.write(head)
    place, checkpoints = len(head), []
    for first in range(0, len(ids), BLOCK):
        part = ids[first:first + BLOCK]
        lanes, states, words = encode_block(part, table)
        data = states.tobytes() + words.tobytes()
        checkpoints.append((place, first, len(part), lanes, len(words), zlib.crc32(data)))
        stream.write(data)
        place += len(data)
    index = zlib.compress(np.array(checkpoints, _CHECKPOINT).tobytes() + np.array(documents, _DOCUMENT).tobytes())
    index = struct.pack("<II", len(checkpoints), len(documents)) + index
    stream.write(index + struct.pack("<QI", place, zlib.crc32(index)))
    return place + len(index) + 12


class Reader:
    """Random access to the blocks and documents of a file."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - 12)
        place, crc = struct.unpack("<QI", stream.read(12))
        stream.seek(place)
        index = stream.read(size - 12 - place)
        if zlib.crc32(index) != crc:
            raise ValueError("damaged index")
        blocks, documents = struct.unpack("<II", index[:8])
        data = zlib.decompress(index[8:])
        self.checkpoints = np.frombuffer(data, _CHECKPOINT, blocks)
        self.documents = np.frombuffer(data, _DOCUMENT, documents, blocks * _CHECKPOINT.itemsize)
        stream.seek(0)
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token ids")
        self.table = Table.read(stream)
        self.slots = np.repeat(np.arange(len(self.table.symbols)), self.table.frequencies.astype(np.int64))

    def block(self, number: int) -> np.ndarray:
        """The ids of one block, on its own."""
        point = self.checkpoints[number]
        self.stream.seek(int(point["place"]))
        states = 8 * int(point["lanes"])
        data = self.stream.read(states + 4 * int(point["words"]))
        if zlib.crc32(data) != point["crc"]:
            raise ValueError(f"damaged block {number}")
        return decode_block(int(point["ids"]), np.frombuffer(data, "<u8", int(point["lanes"])),
                            np.frombuffer(data, "<u4", offset=states).astype(np.uint64), self.table, self.slots)

    def read(self) -> Iterator[tuple[int, np.ndarray]]:
        """Every document with its ids, a block in memory at a time and the document at hand."""
        held, have, number = [np.zeros(0, np.uint32)], 0, 0
        for doc, n in self.documents.tolist():
            while have < n:
                held.append(self.block(number))
                have, number = have + len(held[-1]), number + 1
            joined = np.concatenate(held) if len(held) > 1 else held[0]
            yield doc, joined[:n]
            held, have = [joined[n:]], have - n


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end: int = END) -> DataFrame:
    """Write the ids of all documents to ``folder``; ``task, seq, path, documents, ids, bytes`` per file.

    Files hold ascending document ids, also from file to file. NULL texts count as
    empty and have the id ``end`` alone; rows that repeat an id are documents of their
    own, in the order of their texts; rows without an id are left out; an empty table
    gives no file.
    """
    def write(batches):
        known, task = encoder(tokenizer, drops_space=True), TaskContext.get().partitionId()
        documents, parts, size, seq = [], [], 0, 0

        def file():
            path, stream = fresh_file(folder, "rans")
            with stream:
                written = write_file(stream, documents, np.concatenate(parts))
            return pd.DataFrame([(task, seq, path, len(documents), size, written)],
                                columns=["task", "seq", "path", "documents", "ids", "bytes"])

        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low:low + 256]
                for doc, ids in zip(part["doc_id"].tolist(), known.encode(part["text"].tolist()), strict=True):
                    documents.append((doc, len(ids) + 1))
                    parts.append(np.append(ids, np.uint32(end)))
                    size += len(ids) + 1
                if size >= FILE_IDS:
                    yield file()
                    documents, parts, size, seq = [], [], 0, seq + 1
        if documents:
            yield file()

    docs = texts(docs)
    ordered = docs.repartitionByRange(tasks_for(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInPandas(
        write, "task int, seq int, path string, documents long, ids long, bytes long"), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it. Only one number per writing
    task passes the driver.
    """
    spark = manifest.sparkSession
    totals, before, starts = manifest.groupBy("task").agg(F.sum("ids").alias("n")).orderBy("task").collect(), 0, []
    for task, n in totals:
        starts.append((task, before))
        before += n
    bases = spark.createDataFrame(starts, "task int, base long")
    within = Window.partitionBy("task").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(bases, "task").select("path", (F.col("base") + F.coalesce(F.sum("ids").over(within), F.lit(0))).alias("start"))
    files = max(1, manifest.count())

    def read(batches):
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"].tolist(), strict=True):
                rows = []
                with open_file(path) as stream:
                    for doc, ids in Reader(stream).read():
                        rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(files).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_rans_tokens")
def op8_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(
        table(spark, sf_dir, "documents"), default_tokenizer(), scratch_dir(spark, "token-files")))
