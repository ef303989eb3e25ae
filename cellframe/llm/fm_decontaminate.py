"""Benchmark decontamination with an FM-index per shard of the training text.

Words that no benchmark window holds, and runs of the others that are shorter than the
shortest window, cannot be part of an occurrence. A shard keeps the remaining runs,
with a separator after each, as one sequence: its suffix array (prefix doubling) gives
the Burrows-Wheeler transform, held as a wavelet matrix whose ranks answer backward
search. All windows are searched together, word by word from the last; the rows found
are located by walking back to the nearest sampled suffix position. Occurrences mark
their words, and marked words merge into spans.

The benchmark is the query set: it is gathered in blocks of bounded size, and every
block is searched in all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table, texts

WINDOW = 10
SHARD_WORDS, SHARD_DOCS = 1 << 20, 1 << 14
SAMPLE = 16
BLOCK_BYTES = 8 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split_words(text: str | None) -> list[bytes]:
    """The words of a whole text, A-Z lower-cased; none in an empty or NULL text."""
    return _WORD.findall((text or "").encode().lower())


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling the compared length until all ranks differ."""
    _, rank = np.unique(codes, return_inverse=True)
    length, n = 1, len(codes)
    while n and rank.max() + 1 < n:
        key = rank.astype(np.int64) * (n + 1)
        key[:n - length] += rank[length:] + 1
        _, rank = np.unique(key, return_inverse=True)
        length *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class WaveletMatrix:
    """Ranks of any symbol in any prefix of a sequence, in one step per bit."""

    def __init__(self, sequence: np.ndarray):
        self.levels = max(1, int(sequence.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (sequence >> level) & 1
            self.ones.append(np.append(0, np.cumsum(bits)))
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate((sequence[bits == 0], sequence[bits == 1]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros_like(ends), ends
        for step, level in enumerate(reversed(range(self.levels))):
            one, ones = ((symbols >> level) & 1).astype(bool), self.ones[step]
            low = np.where(one, self.zeros[step] + ones[low], low - ones[low])
            high = np.where(one, self.zeros[step] + ones[high], high - ones[high])
        return high - low

    def access(self, places: np.ndarray) -> np.ndarray:
        symbols = np.zeros_like(places)
        for step in range(self.levels):
            ones = self.ones[step]
            bit = ones[places + 1] - ones[places]
            symbols = symbols * 2 + bit
            places = np.where(bit == 1, self.zeros[step] + ones[places], places - ones[places])
        return symbols


class FMIndex:
    """Backward search and location of words sequences in one shard.

    ``codes`` end with a 0 that occurs nowhere else.
    """

    def __init__(self, codes: np.ndarray):
        order = suffix_array(codes)
        self.tree = WaveletMatrix(codes[order - 1])
        self.before = np.append(0, np.cumsum(np.bincount(codes)))
        self.n = len(codes)
        sampled = order % SAMPLE == 0
        self.sampled = np.append(0, np.cumsum(sampled))
        self.positions = order[sampled]

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the patterns, each in the last ``length`` places of its row."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for step in range(1, width + 1):
            live = np.flatnonzero((lengths >= step) & (low < high))
            if not len(live):
                break
            symbols = patterns[live, width - step]
            present = symbols < len(self.before) - 1
            low[live[~present]] = high[live[~present]] = 0
            live, symbols = live[present], symbols[present]
            low[live] = self.before[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.tree.rank(symbols, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of rows, from the sampled suffix reached by stepping back."""
        out, steps = np.full(len(rows), -1, np.int64), 0
        open_, rows = np.arange(len(rows)), rows.copy()
        while len(open_):
            at = rows[open_]
            hit = self.sampled[at + 1] > self.sampled[at]
            out[open_[hit]] = self.positions[self.sampled[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            symbols = self.tree.access(at)
            rows[open_] = self.before[symbols] + self.tree.rank(symbols, at)
            steps += 1
        return out


class Windows:
    """The distinct windows of a block of benchmark items, as numbers."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.names = [name for name, _ in items]
        found: dict[tuple[bytes, ...], set[int]] = {}
        for k, (_, text) in enumerate(items):
            words = split_words(text)
            for start in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[start:start + window]), set()).add(k)
        vocabulary = sorted({word for words in found for word in words})
        self.codes = {word: k + 2 for k, word in enumerate(vocabulary)}  # 0 ends a shard, 1 a run
        self.lengths = np.array([len(words) for words in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int64)
        for row, words in zip(self.patterns, found, strict=True):
            row[window - len(words):] = [self.codes[word] for word in words]
        self.items = [sorted(owners) for owners in found.values()]
        self.shortest = int(self.lengths.min(initial=window))

    def search(self, documents: list[np.ndarray]) -> list[tuple[list[int], list[int], list[int]]]:
        """Per document, given its words' codes (0 for other words): span starts, ends, items."""
        places, owners, codes = [], [], []
        for doc, own in enumerate(documents):
            edge = np.flatnonzero(np.diff((own > 0).view(np.int8), prepend=0, append=0))
            for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if end - start >= self.shortest:
                    codes += [own[start:end], [1]]
                    places.append(np.arange(start, end + 1))
                    owners.append(np.full(end + 1 - start, doc))
        empty: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in documents]
        if not codes or not len(self.lengths):
            return empty
        index = FMIndex(np.concatenate([*codes, [0]]).astype(np.int64))
        low, high = index.find(self.patterns, self.lengths)
        hit = np.flatnonzero(low < high)
        counts = (high - low)[hit]
        which = np.repeat(hit, counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[hit], counts)
        at = index.locate(rows)
        doc, start = np.concatenate(owners)[at], np.concatenate(places)[at]
        order = np.lexsort((start, doc))
        doc, start, which = doc[order], start[order], which[order]
        for first, last in zip(*(np.searchsorted(doc, np.unique(doc), side) for side in ("left", "right")), strict=True):
            own = slice(int(first), int(last))
            starts, ends = merged(start[own], start[own] + self.lengths[which[own]])
            items = sorted({item for w in np.unique(which[own]).tolist() for item in self.items[w]})
            empty[int(doc[first])] = starts, ends, items
        return empty


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Spans sorted by start, with overlapping and touching ones made one."""
    reach = np.maximum.accumulate(ends)
    fresh = np.append(True, starts[1:] > reach[:-1])
    return starts[fresh].tolist(), reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(starts) - 1)].tolist()


_FOUND = "n_words long, starts array<long>, ends array<long>, items array<string>"


def _found_by(windows, batches, passed: list[str]):
    """Shards of the batches' rows: their columns ``passed`` and what was found in them."""
    rows, codes, size = [], [], 0

    def shard():
        spans = windows.search([c for c, _ in codes])
        frame = pd.DataFrame(rows, columns=passed)
        frame["n_words"] = [n for _, n in codes]
        frame["starts"], frame["ends"] = [s for s, _, _ in spans], [e for _, e, _ in spans]
        frame["items"] = [[windows.names[k] for k in items] for _, _, items in spans]
        return frame

    for batch in batches:
        for row, text in zip(batch[passed].itertuples(index=False), batch["text"], strict=True):
            words = split_words(text)
            rows.append(tuple(row))
            codes.append((np.fromiter(map(windows.codes.get, words, repeat(0)), np.int32, len(words)), len(words)))
            size += len(words)
            if size >= SHARD_WORDS or len(rows) >= SHARD_DOCS:
                yield shard()
                rows, codes, size = [], [], 0
    if rows:
        yield shard()


def _blocks(benchmark: DataFrame, window: int) -> tuple[int, Iterator[Windows]]:
    """How many blocks of items there are, and their windows, one block in memory at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string")).where(
        "item_id IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = 1 + total // BLOCK_BYTES
    return blocks, (Windows([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).distinct()
                             .orderBy("item_id", "text").collect()], window) for k in range(blocks))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, starts, ends, items`` of every row with an id.

    ``starts`` and ``ends`` are the merged spans of words inside occurrences (word
    numbers, end exclusive), ``items`` the ids of items with an occurring window. Words
    are compared with A-Z lower-cased. Empty and NULL texts have no words and no spans;
    items without words or id are never found; repeated items count once; rows that
    repeat an id are searched each.
    """
    spark = docs.sparkSession
    keyed = texts(docs).select("doc_id", F.xxhash64("text").alias("version"), "text")
    found = None
    blocks, each = _blocks(benchmark, window)
    for windows in each:
        shared = spark.sparkContext.broadcast(windows)  # windows of at most about BLOCK_BYTES of text

        def search(batches, shared=shared):
            return _found_by(shared.value, batches, ["doc_id", "version"])

        block = keyed.mapInPandas(search, f"doc_id long, version long, {_FOUND}")
        if blocks > 1:  # finished before the next is built
            block = stored(block, "contamination")
            shared.destroy()
        found = block if found is None else _combined(found, block)
    return found.drop("version")


def _combined(left: DataFrame, right: DataFrame) -> DataFrame:
    """The findings of two blocks of items in the same documents, one row per text."""
    spans = F.expr("""aggregate(array_sort(concat(
        zip_with(starts, ends, (s, e) -> named_struct('starts', s, 'ends', e)),
        zip_with(more_starts, more_ends, (s, e) -> named_struct('starts', s, 'ends', e)))),
      CAST(array() AS array<struct<starts:bigint,ends:bigint>>), (done, s) -> CASE
        WHEN size(done) > 0 AND done[size(done) - 1].ends >= s.starts
        THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
          'starts', done[size(done) - 1].starts, 'ends', greatest(done[size(done) - 1].ends, s.ends))))
        ELSE concat(done, array(s)) END)""")
    more = right.dropDuplicates(["doc_id", "version"]).select(
        "doc_id", "version", *(F.col(c).alias(f"more_{c}") for c in ("starts", "ends", "items")))
    return left.join(more, ["doc_id", "version"]).withColumn("spans", spans).select(
        "doc_id", "version", "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"),
        F.array_sort(F.array_union("items", "more_items")).alias("items"))


def digests(found: DataFrame) -> DataFrame:
    """The findings as counts and a hash of the sorted item ids."""
    hit = F.expr("aggregate(zip_with(starts, ends, (s, e) -> e - s), 0L, (sum, n) -> sum + n)")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark.

    NULL and empty texts stay, and so do rows without an id whose text is clean.
    """
    blocks, each = _blocks(benchmark, window)
    for windows in each:
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        docs = docs.where(_clean(shared)(F.col("text").cast("string")))
        if blocks > 1:
            docs = stored(docs, "clean")
            shared.destroy()
    return docs


def _clean(shared):
    """A function that is true for texts without any window."""
    def is_clean(column: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"row": np.arange(len(column)), "text": column.to_numpy()})
        found = [not len(starts) for part in _found_by(shared.value, [frame], ["row"]) for starts in part["starts"]]
        return pd.Series(found, dtype=bool)

    return F.pandas_udf(is_clean, "boolean")


@query("op7_fm_decontaminate")
def op7_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
