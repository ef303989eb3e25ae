"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max index.

The index holds every word of the labelled examples (at most ``most``). Examples are put in
an order that keeps similar ones together and cut into blocks. Words that many examples
hold are rows of a dense matrix, multiplied for many texts at once; words of a few
examples are added up posting by posting. All others have posting lists in blocks, each
with its largest weight: with a text's weights these bound what a block's examples can
still gain. Blocks are visited in falling order of their bounds, and once a bound is below
the k-th cosine so far, all that follow are left out. The search runs in single precision
with room for its rounding; what it finds is compared again in double precision: the
result is exact.

Neighbours vote with weights that fall with their distance and grow with the agreement
in words whose document frequency differs between the labels; so distances are those of
the whole texts, and the vote follows what sets the labels apart. A logistic curve
fitted to leave-one-out votes turns votes into scores. The nearest examples are the
evidence.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, remainder, table, texts
from .labelled import MAX_EXAMPLES, examples

NEIGHBOURS, CALIBRATED = 15, 2000
# The layout of the index, without effect on results: words in a dense matrix, texts at once,
# examples of a block, blocks visited first, the most examples of a word added up at once, and
# groups of similar examples.
COMMON_SHARE, COMMON, TOGETHER = 0.05, 512, 64
BLOCK, FIRST_BLOCKS, FEW, GROUPS = 512, 6, 24, 64
ROUNDING = 1e-4  # far above what single precision can lose in a cosine
_SEPARATORS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The lower-case words of a whole text."""
    return (text or "").lower().encode().translate(_SEPARATORS).split()


def _alike(dense: np.ndarray) -> np.ndarray:
    """An order of the columns that keeps similar ones together: groups around a few of them, drawn nearer in turns."""
    columns = np.ascontiguousarray(dense.T)
    columns /= np.maximum(np.linalg.norm(columns, axis=1, keepdims=True), 1e-9)
    n = len(columns)
    centers = columns[np.linspace(0, max(0, n - 1), min(GROUPS, n)).astype(int)].copy()
    for _ in range(5):
        group = np.argmax(columns @ centers.T, axis=1) if n else np.zeros(0, int)
        for k in range(len(centers)):
            total = columns[group == k].sum(axis=0)
            centers[k] = total / max(np.linalg.norm(total), 1e-9)
    return np.argsort(group, kind="stable").astype(np.int32)


class Index:
    """Examples as unit vectors over all their words, by word and by example."""

    def __init__(self, vocabulary: list[bytes], ids, bags: Iterable[dict[int, int]], labels):
        pairs = [(np.fromiter(bag, np.int32, len(bag)), np.fromiter(bag.values(), np.int32, len(bag))) for bag in bags]
        sizes = np.array([len(t) for t, _ in pairs], np.int64)
        terms, counts = (np.concatenate([np.zeros(0, np.int32), *(pair[k] for pair in pairs)]) for k in (0, 1))
        del pairs
        self.slope, self.shift = 1.0, 0.0
        self._build(vocabulary, np.asarray(ids, np.int64), np.asarray(labels, float), sizes, terms, counts, None)

    def __getstate__(self):
        """What the index is built from; the rest is built again where it is used."""
        arrays = [zlib.compress(array.tobytes(), 1) for array in self._source]
        return zlib.compress(b" ".join(self.vocabulary), 1), arrays, self.slope, self.shift

    def __setstate__(self, state):
        vocabulary, arrays, self.slope, self.shift = state
        types = np.int64, float, np.int64, np.int32, np.int32, np.int32
        self._build(zlib.decompress(vocabulary).split(), *(
            np.frombuffer(zlib.decompress(array), dtype) for array, dtype in zip(arrays, types, strict=True)))
        del self._source

    def _build(self, vocabulary: list[bytes], ids, labels, sizes, terms, counts, order) -> None:
        self.vocabulary = {word: k for k, word in enumerate(vocabulary)}
        self.rate = (labels.sum() + 0.5) / (len(labels) + 2)
        size = len(vocabulary)
        frequency = np.bincount(terms, minlength=size)
        self.idf = np.log((1 + len(labels)) / (1 + frequency)) + 1
        self.contrast = self._contrast(frequency, np.bincount(terms, np.repeat(labels, sizes), size), labels)
        used = sizes > 0
        self.ids, self.labels = ids[used], labels[used]
        self.terms = terms
        self.starts = np.append(0, np.cumsum(sizes[used]))
        places = np.repeat(np.arange(len(self.ids), dtype=np.int32), sizes[used])
        self.weights = (1 + np.log(counts)) * self.idf[terms]
        self.weights /= np.sqrt(np.bincount(places, self.weights ** 2, len(self.ids)))[places]
        self.norms = np.sqrt(np.bincount(places, self.weights ** 2 * self.contrast[terms], len(self.ids)))
        common = np.argsort(-frequency, kind="stable")[:COMMON]
        common = common[frequency[common] > COMMON_SHARE * len(labels)]
        self.row = np.full(size, -1, np.int32)
        self.row[common] = np.arange(len(common))
        n, dense = len(self.ids), self.row[terms] >= 0
        table = np.zeros((len(common), n), np.float32)
        table[self.row[terms[dense]], places[dense]] = self.weights[dense]
        # From here on examples are numbered in the order that keeps similar ones together.
        self.order = _alike(table) if order is None else order
        self._source = ids, labels, sizes, terms, counts, self.order
        self.place = np.empty(n, np.int32)
        self.place[self.order] = np.arange(n, dtype=np.int32)
        self.dense = table[:, self.order]
        rest = np.flatnonzero(~dense)
        places = self.place[places[rest]]
        by = np.lexsort((places, terms[rest]))
        self.places, self.listed = places[by], self.weights[rest[by]].astype(np.float32)
        listed = terms[rest[by]]
        self.offsets = np.searchsorted(listed, np.arange(size + 1))
        self.few = np.diff(self.offsets) <= FEW
        # Posting lists of the other words in blocks: where they start, which block, largest weight.
        starts = np.flatnonzero(np.diff(listed.astype(np.int64) * (n + 1) + self.places // BLOCK, prepend=-1))
        starts = starts[~self.few[listed[starts]]]
        ends = np.append(starts[1:], len(listed))
        ends = np.minimum(ends, self.offsets[listed[starts] + 1])
        self.pieces = starts, ends - starts
        self.piece_block = self.places[starts] // BLOCK
        self.piece_most = np.array([], np.float32) if not len(starts) else np.maximum.reduceat(
            np.append(self.listed, np.float32(0)), np.column_stack((starts, ends)).ravel())[::2]
        self.piece_offsets = np.searchsorted(listed[starts], np.arange(size + 1))
        self.blocks = np.arange(0, n, BLOCK)

    @staticmethod
    def _contrast(frequency: np.ndarray, positive: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The fourth power of the z-score between the labels, per word; 1 without both labels.

        Both vectors of an agreement have each word multiplied with its squared z-score.
        """
        ones, zeros = labels.sum(), len(labels) - labels.sum()
        if not ones or not zeros:
            return np.ones(len(frequency))
        pooled = frequency / len(labels)
        spread = np.sqrt(pooled * (1 - pooled) * (1 / ones + 1 / zeros))
        return ((positive / ones - (frequency - positive) / zeros) / np.maximum(spread, 1e-12)) ** 4

    def _unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[terms]
        return weights / np.sqrt((weights ** 2).sum())

    @property
    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self._vector(place) for place in range(len(self.ids))]

    def _vector(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[place], self.starts[place + 1])
        return self.terms[own], self.weights[own]

    def bag(self, text: str | None) -> dict[int, int]:
        return {self.vocabulary[word]: n for word, n in Counter(words(text)).items() if word in self.vocabulary}

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The same as arrays of words and counts."""
        found = map(self.vocabulary.get, words(text), repeat(-1))
        numbers, n = np.unique(np.fromiter(found, np.int32), return_counts=True)
        known = numbers >= 0
        return numbers[known], n[known]

    def vector(self, bag: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(bag, np.int32, len(bag))
        return terms, self._unit(terms, np.fromiter(bag.values(), np.float64, len(bag)))

    def _ranges(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """All numbers of some ranges."""
        return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)

    def _near(self, own: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, skip: int | None, tally: Counter | None) -> np.ndarray:
        """The places, in the index's order, of all examples that can be among the ``k`` nearest.

        ``own`` has the cosines' share of the dense matrix.
        """
        rest = self.row[terms] < 0
        terms, weights = terms[rest], weights[rest].astype(np.float32)
        few = self.few[terms]
        starts = self.offsets[terms[few]]
        sizes = self.offsets[terms[few] + 1] - starts
        at = self._ranges(starts, sizes)
        np.add.at(own, self.places[at].astype(np.intp), np.repeat(weights[few], sizes) * self.listed[at])
        if skip is not None:
            own[skip] = -2
        terms, weights = terms[~few], weights[~few]
        starts = self.piece_offsets[terms]
        sizes = self.piece_offsets[terms + 1] - starts
        pieces, factors = self._ranges(starts, sizes), np.repeat(weights, sizes)
        block = self.piece_block[pieces]
        bounds = np.maximum.reduceat(own, self.blocks) + np.bincount(block, factors * self.piece_most[pieces], len(self.blocks))
        order = np.argsort(-bounds, kind="stable")
        least, low, step, found = -np.inf, 0, FIRST_BLOCKS, []
        while low < len(order) and bounds[order[low]] >= max(least, 0) - ROUNDING:
            now = order[low:low + step]
            now = now[bounds[now] >= max(least, 0) - ROUNDING]
            visited = np.zeros(len(self.blocks), bool)
            visited[now] = True
            mine = visited[block]
            starts, sizes = self.pieces[0][pieces[mine]], self.pieces[1][pieces[mine]]
            at = self._ranges(starts, sizes)
            own += np.bincount(self.places[at], np.repeat(factors[mine], sizes) * self.listed[at], len(own)).astype(np.float32)
            places = self._ranges(self.blocks[now], np.minimum(BLOCK, len(own) - self.blocks[now]))
            places = places[own[places] >= least - ROUNDING]
            found = np.concatenate([found, places]).astype(np.int64)
            if len(found) >= k:
                least = np.partition(own[found], -k)[-k]
            low += len(now)
            if len(now) < step:
                break
            # With enough found, what is left above their bound is visited together.
            step = len(order) if len(found) >= k else 2 * step
        if tally is not None:
            tally.update(visited=low, blocks=len(order))
        found = np.asarray(found, np.int64)
        return found[(own[found] >= least - ROUNDING) & (own[found] > 0)]

    def search_all(self, vectors, k: int = NEIGHBOURS, skips=None, tally: Counter | None = None):
        """For each of some texts: places, cosines and agreements of the ``k`` nearest examples, ties by place."""
        sums, asked = np.zeros((len(vectors), len(self.dense)), np.float32), np.zeros(len(self.idf))
        for own, (terms, weights) in zip(sums, vectors, strict=True):
            rows = self.row[terms]
            own[rows[rows >= 0]] = weights[rows >= 0]
        sums = sums @ self.dense
        for number, (own, (terms, weights)) in enumerate(zip(sums, vectors, strict=True)):
            skip = None if skips is None else self.place[skips[number]]
            near = self.order[self._near(own, terms, weights, k, skip, tally)]
            asked[terms] = weights
            sizes = self.starts[near + 1] - self.starts[near]
            firsts = np.cumsum(sizes) - sizes
            at = self._ranges(self.starts[near], sizes)
            shared = asked[self.terms[at]] * self.weights[at]
            asked[terms] = 0
            if len(near):
                values = np.add.reduceat(shared, firsts)
                norm = np.sqrt((weights ** 2 * self.contrast[terms]).sum())
                agreed = np.add.reduceat(shared * self.contrast[self.terms[at]], firsts) / np.maximum(self.norms[near] * norm, 1e-300)
            else:
                values = agreed = np.zeros(0)
            best = np.lexsort((near, -values))[:k]
            yield near[best], values[best], agreed[best]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS):
        """Places and cosines of the ``k`` nearest examples, ties by place."""
        return next(self.search_all([(terms, weights)], k))[:2]

    def vote(self, places: np.ndarray, cosines: np.ndarray, agreed: np.ndarray) -> float:
        """The weighted rate of label 1 among the neighbours, as log-odds."""
        weights = (agreed + 1e-6) / (1.05 - np.minimum(cosines, 1.0))
        rate = ((weights * self.labels[places]).sum() + self.rate) / (weights.sum() + 1)
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        return float(np.log(rate / (1 - rate)))

    def calibrate(self, calibrated: int = CALIBRATED) -> None:
        """Fit the logistic curve to leave-one-out votes, with a weak pull to the identity.

        At most ``calibrated`` examples vote, evenly spread over the index.
        """
        if len(np.unique(self.labels)) < 2:
            return
        chosen = list(range(0, len(self.ids), -(-len(self.ids) // calibrated)))
        votes = np.array([self.vote(*found) for k in range(0, len(chosen), TOGETHER) for found in self.search_all(
            [self._vector(place) for place in chosen[k:k + TOGETHER]], skips=chosen[k:k + TOGETHER])])
        labels = self.labels[chosen]
        x, w = np.stack([votes, np.ones_like(votes)], 1), np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            gradient = x.T @ (labels - p) - (w - [1.0, 0.0])
            step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(2), gradient)
            w = w + step
            if np.abs(step).max() < 1e-9:
                break
        if w[0] > 0:
            self.slope, self.shift = map(float, w)

    def scores(self, batch) -> list[tuple[float, list[int]]]:
        """The calibrated scores of whole texts and the ids of their nearest examples."""
        out: list[tuple[float, list[int]]] = [(float(self.rate), [])] * len(batch)
        known = [(k, own) for k, text in enumerate(batch) if len(self.ids) and len((own := self.counted(text))[0])]
        for first in range(0, len(known), TOGETHER):
            part = known[first:first + TOGETHER]
            for (k, _), (places, cosines, agreed) in zip(part, self.search_all([(terms, self._unit(terms, n)) for _, (terms, n) in part]), strict=True):
                if len(places):
                    logit = self.slope * self.vote(places, cosines, agreed) + self.shift
                    out[k] = float(1 / (1 + np.exp(-np.clip(logit, -35, 35)))), self.ids[places[:3]].tolist()
        return out


class Packed:
    """A pickled index, which becomes the index where a broadcast of it is read."""

    def __init__(self, state: bytes):
        self.state = state

    def __reduce__(self):
        return pickle.loads, (self.state,)


def packed_index(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES, calibrated: int = CALIBRATED) -> Packed:
    """Index at most ``most`` labelled rows with crc32(doc_id) mod 5 other than 0, in one task."""
    known = examples(docs, labels, "toxic", 5, 0, most)

    def counted(batches):
        for batch in batches:
            bags = [Counter(words(text)) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "words": [b" ".join(bag) for bag in bags],
                                "counts": [np.fromiter(bag.values(), np.int32, len(bag)).tobytes() for bag in bags]})

    def built(batches):
        rows = [row for batch in batches for row in batch.itertuples(index=False)]
        rows.sort(key=lambda row: row.doc_id)
        vocabulary: dict[bytes, int] = {}
        bags = [(np.array([vocabulary.setdefault(word, len(vocabulary)) for word in row.words.split()], np.int32),
                 np.frombuffer(row.counts, np.int32)) for row in rows]
        ids, labels = [row.doc_id for row in rows], [row.y for row in rows]
        del rows
        index = Index(list(vocabulary), ids, (dict(zip(t.tolist(), n.tolist(), strict=True)) for t, n in bags), labels)
        index.calibrate(calibrated)
        yield pd.DataFrame({"state": [pickle.dumps(index)]})

    # The distinct words of at most ``most`` rows.
    counts = known.mapInPandas(counted, "doc_id long, y int, words binary, counts binary").repartition(1)
    found = counts.mapInPandas(built, "state binary").collect()
    return Packed(bytes(found[0]["state"]) if found else pickle.dumps(Index([], [], [], [])))


def build_index(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> Index:
    return pickle.loads(packed_index(docs, labels, most).state)


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES, calibrated: int = CALIBRATED) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row with an id.

    ``evidence`` are the ids of the nearest examples. Only the text is scored, all of
    it; texts without any word of an example, empty and NULL ones get the examples' rate. Repeated rows get equal scores; an empty table gives an empty result.
    """
    index = docs.sparkSession.sparkContext.broadcast(packed_index(docs, labels, most, calibrated))  # bounded by ``most``

    def score(batches):
        for batch in batches:
            found = index.value.scores(batch["text"])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [f[0] for f in found], "evidence": [f[1] for f in found]})

    scored = texts(docs).mapInPandas(score, "doc_id long, score double, evidence array<long>")
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
