"""Alignment of two tokenizers' tokens over whole texts by sparse incidence products.

Each side's tokens are a matrix of tokens by bytes in compressed rows. The row product of
one side with the other's transpose (for each byte of a token, add the row of that byte)
gives the tokens that overlap, with the bytes they share; those whose ranges end together
are one-to-one ends. Byte offsets where tokens of both sides end cut them into groups;
the product of the groups' incidence matrices gives the tokens that share a group.

Both tokenizers cut a text where a space or line end follows another character, so texts
are aligned piece by piece, and each worker aligns a piece once. Counts of id pairs cover
all documents. Of two tokens that end together the shorter is the end of the longer, so
there are never more pairs than bytes in both vocabularies (twice, as single bytes may have
two ids): the counts have a bound that no corpus moves.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table, texts

# Pieces of a generation that a worker remembers, the longest of them, pieces encoded as one
# text, documents and characters taken at a time, and pair numbers counted at a time.
KNOWN, KNOWN_CHARACTERS = 150_000, 48
TOGETHER = 256
DOCUMENTS, CHARACTERS = 256, 1 << 20
COUNTED = 1 << 21

# White space with the word behind it; a space or line end behind a word starts the next.
_PIECE = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")


@dataclass
class Rows:
    """A sparse matrix in compressed rows: where rows start, columns and values."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def incidence(cls, columns: Sequence[np.ndarray] | np.ndarray, starts: np.ndarray, width: int) -> Rows:
        columns = np.asarray(columns, np.int64)
        return cls(np.asarray(starts, np.int64), columns, np.ones(len(columns), np.int64), width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=starts[1:])
        return Rows(starts, self.row_numbers()[order], self.values[order], self.height)

    def times(self, other: Rows) -> Rows:
        """The product, row by row: each value of a row adds a multiple of a row of ``other``."""
        sizes = np.diff(other.starts)[self.columns]
        rows = np.repeat(self.row_numbers(), sizes)
        ends = np.cumsum(sizes)
        places = np.arange(len(rows)) - np.repeat(ends - sizes, sizes) + np.repeat(other.starts[self.columns], sizes)
        products = np.repeat(self.values, sizes) * other.values[places]
        width = max(1, other.width)
        keys = rows * width + other.columns[places]
        order = np.argsort(keys, kind="stable")
        keys, products = keys[order], products[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        sums = np.add.reduceat(products, first) if len(first) else products
        keys = keys[first]
        starts = np.searchsorted(keys // width, np.arange(self.height + 1))
        return Rows(starts, keys % width, sums, other.width)


def token_bytes(ends: np.ndarray) -> Rows:
    """Tokens by bytes, from the offsets where tokens end."""
    n = int(ends[-1]) if len(ends) else 0
    return Rows.incidence(np.arange(n), np.concatenate([[0], ends]), n)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> Rows:
    """A tokens by B tokens: how many bytes they share."""
    return token_bytes(a_ends).times(token_bytes(b_ends).transposed())


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token."""
    cuts = np.intersect1d(a_ends, b_ends)
    return np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)


def shared_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> Rows:
    """A tokens by B tokens of the same group."""
    a_group, b_group = groups(a_ends, b_ends)
    n = int(a_group[-1]) + 1 if len(a_group) else 0
    # Tokens by groups, times groups by tokens.
    left = Rows.incidence(a_group, np.arange(len(a_group) + 1), n)
    return left.times(Rows.incidence(b_group, np.arange(len(b_group) + 1), n).transposed())


# --- tokenizers -----------------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones as they
    are, all others in order from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Encoded:
    """Parts of texts in some order, the byte offsets where they end, and both sides' ids and ends.

    ``good`` tells of all given parts whether both tokenizers give their bytes back; the
    others are not in the order.
    """

    order: list[int]
    ends: np.ndarray
    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    good: np.ndarray


class Tokens:
    """Ids and byte lengths of texts, each led by a space."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = byte_level_alphabet()
        self.a_bytes: dict[int, bytes] = {}
        for token, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = [self._piece(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(self.a_bytes.get(k, b"")) for k in range(max(self.a_bytes) + 1)], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    @staticmethod
    def _piece(piece: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _strings(self, strings: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides for texts that start with white space; ``None`` where bytes differ."""
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        # A line end before the text takes the space that the library adds, and joins nothing.
        b = [ids[2:] for ids in self.b.encode(["\n" + s for s in strings], num_threads=1)]
        out = []
        for text, x, y in zip(strings, a, b, strict=True):
            raw = text.encode()
            same = b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y))
            out.append((x, y) if same else None)
        return out

    def encode(self, parts: list[str]) -> Encoded:
        """Both sides' ids of parts that start with white space, side by side.

        Parts that end in a character follow one another in one text, as they do in
        documents; the libraries are slow to call.
        """
        joined, alone = [], []
        for k, part in enumerate(parts):
            (alone if part[-1].isspace() or "▁" in part else joined).append(k)
        groups = [joined[low:low + TOGETHER] for low in range(0, len(joined), TOGETHER)]
        found = []  # the parts of a text, and its ids
        for low in range(0, len(groups), 16):
            some = groups[low:low + 16]
            for group, ids in zip(some, self._strings(["".join([parts[k] for k in g]) for g in some])):
                if ids is None:
                    alone += group
                else:
                    found.append((group, ids))
        good = np.zeros(len(parts), bool)
        for low in range(0, len(alone), 512):
            some = alone[low:low + 512]
            found += [([k], ids) for k, ids in zip(some, self._strings([parts[k] for k in some])) if ids is not None]
        order = [k for group, _ in found for k in group]
        good[order] = True
        a = np.array([i for _, (x, _) in found for i in x], np.int64)
        b = np.array([i for _, (_, y) in found for i in y], np.int64)
        ends = np.cumsum([len(parts[k].encode()) for k in order], dtype=np.int64)
        return Encoded(order, ends, a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]), good)

    def encode_whole(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids of one text, led by a space; ``None`` where there are no tokens."""
        found = self._strings([" " + text])[0] if text else None
        return None if found is None else (np.array(found[0], np.int64), np.array(found[1], np.int64))

    @property
    def most_pairs(self) -> int:
        """No corpus has more pairs of ids that end together."""
        return 2 * (sum(map(len, self.a_bytes.values())) + sum(map(len, self.b_bytes)))


class Aligner:
    """Aligned pieces of one worker process, and documents put together from them.

    What a piece comes to is remembered in two generations: when the younger is full it
    becomes the older one, and pieces that are met again move to the new younger one.
    """

    def __init__(self, byte_level: str, pieces: str, most: int = KNOWN):
        self.tokens, self.most = Tokens(byte_level, pieces), most
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        n_a, n_b = len(self.tokens.a_sizes), len(self.tokens.b_sizes)
        # How ids are written inside a group, and where their side of it ends.
        self.inside = [f"{k}," for k in range(max(n_a, n_b))]
        self.last_a = [f"{k}|" for k in range(n_a)]
        self.last_b = [f"{k};" for k in range(n_b)]

    def align(self, parts: list[str]) -> list[tuple]:
        """``A tokens, B tokens, groups, groups text, pair numbers`` of pieces, side by side in one pair of matrices."""
        e = self.tokens.encode(parts)
        shared = overlaps(e.a_ends, e.b_ends)
        a, b = shared.row_numbers(), shared.columns
        together = e.a_ends[a] == e.b_ends[b]  # overlapping tokens whose ranges end together
        a, b = a[together], b[together]
        pairs = (e.a[a] * len(self.tokens.b_sizes) + e.b[b]).astype("<u4").tobytes()
        # Each common end closes a group of tokens of both sides.
        a_group, b_group = np.searchsorted(a, np.arange(len(e.a))), np.searchsorted(b, np.arange(len(e.b)))
        written = [self.inside[k] for k in e.a.tolist()] + [self.inside[k] for k in e.b.tolist()]
        for k in a.tolist():
            written[k] = self.last_a[e.a[k]]
        for k in b.tolist():
            written[len(e.a) + k] = self.last_b[e.b[k]]
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable").tolist()
        written = [written[k] for k in order]
        to_a, to_b = (np.searchsorted(x, e.ends, side="right").tolist() for x in (e.a_ends, e.b_ends))
        to_link = np.searchsorted(e.a_ends[a], e.ends, side="right").tolist()
        out: list = [None] * len(parts)
        x = y = z = 0
        for k, x2, y2, z2 in zip(e.order, to_a, to_b, to_link):
            out[k] = x2 - x, y2 - y, z2 - z, "".join(written[x + y:x2 + y2])[:-1], pairs[4 * z:4 * z2]
            x, y, z = x2, y2, z2
        return out

    def _pieces(self, parts: list[list[str]]) -> dict[str, tuple]:
        """Everything that is known of the pieces of some documents."""
        wanted = set().union(*parts)
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        missing = wanted.difference(self.young)
        again = missing.intersection(self.old)
        self.young.update((p, self.old[p]) for p in again)
        fresh = list(missing.difference(again))
        if not fresh:
            return self.young
        made = dict(zip(fresh, self.align(fresh)))
        long = {p: made.pop(p) for p in fresh if len(p) > KNOWN_CHARACTERS}
        self.young.update(made)
        return {**self.young, **long} if long else self.young

    def documents(self, docs: list[str | None]) -> Iterator[tuple[int, int, int, int, str, bytes]]:
        """``n_a, n_b, n_groups, n_links, groups, pair numbers`` of each text."""
        parts = [_PIECE.findall(" " + text) if text else [] for text in docs]
        known = self._pieces(parts)
        for own in parts:
            found = [known[p] for p in own]
            if not found or None in found:
                yield 0, 0, 0, 0, "", b""
                continue
            n_a, n_b, n_groups, texts, pairs = zip(*found)
            links = b"".join(pairs)
            yield sum(n_a), sum(n_b), sum(n_groups), len(links) // 4, ";".join(texts), links


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(byte_level: str, pieces: str) -> Aligner:
    """The aligner of this worker process: what it has learnt serves all its tasks."""
    if (byte_level, pieces) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[byte_level, pieces] = Aligner(byte_level, pieces)
    return _ALIGNERS[byte_level, pieces]


# --- documents ------------------------------------------------------------------------

def links(docs: DataFrame, byte_level: str, pieces: str, kind: str = "overlap") -> DataFrame:
    """``doc_id, a, a_id, b, b_id, weight`` of every link between tokens of whole texts.

    ``a`` and ``b`` are places of tokens. ``kind`` is ``overlap`` (weight: shared bytes) or
    ``group`` (weight 1). Texts without tokens, by the rules of ``aligned``, have none.
    """
    if kind not in ("overlap", "group"):
        raise ValueError(f"kind must be 'overlap' or 'group', not {kind!r}")

    def run(batches):
        known = aligner(byte_level, pieces).tokens
        for batch in batches:
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                found = known.encode_whole(text)
                if found is None:
                    continue
                a, b = found
                product = (overlaps if kind == "overlap" else shared_groups)(np.cumsum(known.a_sizes[a]), np.cumsum(known.b_sizes[b]))
                rows = product.row_numbers()
                yield pd.DataFrame({"doc_id": doc, "a": rows, "a_id": a[rows], "b": product.columns,
                                    "b_id": b[product.columns], "weight": product.values})

    return texts(docs).mapInPandas(run, "doc_id long, a long, a_id long, b long, b_id long, weight long")


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs`` of every document.

    ``groups`` is the text of the groups; ``pairs`` are the numbers (A id times B ids plus
    B id) of the tokens that end together, in order. Texts that are NULL or empty, or that
    one of the tokenizers does not give back byte for byte, have no tokens. Rows that
    repeat an id are documents of their own; rows without an id are left out; other columns
    play no part.
    """
    return _aligned(docs, byte_level, pieces, "groups", lambda n, groups: groups)


def _digest(n: int, groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if n else ""


def _aligned(docs: DataFrame, byte_level: str, pieces: str, name: str, shown: Callable[[int, str], str]) -> DataFrame:
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", name, "pairs"]

    def run(batches):
        known = aligner(byte_level, pieces)
        for batch in batches:
            ids, held, low = batch["doc_id"].tolist(), batch["text"].tolist(), 0
            while low < len(ids):
                high, size = low, 0
                while high < len(ids) and high - low < DOCUMENTS and (size < CHARACTERS or high == low):
                    size, high = size + len(held[high] or ""), high + 1
                rows = [(doc, a, b, g, n, shown(a, groups), pairs) for doc, (a, b, g, n, groups, pairs)
                        in zip(ids[low:high], known.documents(held[low:high]), strict=True)]
                yield pd.DataFrame(rows, columns=columns)
                low = high

    return texts(docs).mapInPandas(
        run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {name} string, pairs binary")


def pair_counts(alignments: DataFrame) -> DataFrame:
    """``pair, n``: how many links of all documents hold each pair of ids, combined in each task first."""
    def run(batches):
        held, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        loose: list[np.ndarray] = []

        def combined():
            keys = np.concatenate([k for k, _ in held])
            numbers, inverse = np.unique(keys, return_inverse=True)
            return numbers, np.bincount(inverse, np.concatenate([n for _, n in held]), len(numbers)).astype(np.int64)

        for batch in batches:
            for pairs in batch["pairs"]:
                loose.append(np.frombuffer(pairs, "<u4"))
                size += len(loose[-1])
                if size >= COUNTED:
                    keys, n = np.unique(np.concatenate(loose), return_counts=True)
                    held.append((keys.astype(np.int64), n))
                    held, loose, size = [combined()], [], 0
        if loose:
            keys, n = np.unique(np.concatenate(loose), return_counts=True)
            held.append((keys.astype(np.int64), n))
        numbers, n = combined()
        yield pd.DataFrame({"pair": numbers, "n": n})

    return alignments.select("pairs").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def digests(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Per document the sizes of its alignment, how its links fare in the whole corpus, and the hash of its groups."""
    spark = docs.sparkSession
    kept = stored(_aligned(docs, byte_level, pieces, "groups_sha256", _digest), "alignments")
    width = len(Tokens(byte_level, pieces).b_bytes)
    counts = pair_counts(kept).toPandas().sort_values("pair")  # at most Tokens.most_pairs rows
    numbers, n = counts["pair"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    most = np.zeros(width, np.int64)
    np.maximum.at(most, numbers % width, n)
    shared = spark.sparkContext.broadcast((numbers, n, n == most[numbers % width]))

    def scored(batches):
        numbers, n, best = shared.value
        for batch in batches:
            at = [np.searchsorted(numbers, np.frombuffer(pairs, "<u4")) for pairs in batch["pairs"]]
            yield batch.drop(columns="pairs").assign(
                n_best=[int(best[k].sum()) for k in at], count_sum=[int(n[k].sum()) for k in at])

    return kept.mapInPandas(scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                    "n_best long, count_sum long")


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                   public_tokenizers.path("piece_bpe_32k.model"))
