"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into at most ``BINS`` bins. Boosting visits the features in turn;
each visit fits a tree of at most four leaves to the gradient and adds it to that
feature's lookup table. Then the strongest pairs get tables of their own in the same
way. A score is the sigmoid of the sum of the looked-up values: bin numbers and
additions over whole batches.

The model is fitted on the driver, on the features of a bounded sample (``most`` rows,
a few MB); features and scores of the corpus are computed by Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, remainder, table, texts
from .labelled import MAX_EXAMPLES, examples

BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, RIDGE = 0.15, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "bangs", "pipes", "marks", "non_ascii",
    "distinct_words", "capitalised", "longest_word", "repeated_lines", "line_words", "repeated_pairs", "spaces")
_UPPER, _LOWER, _DIGIT = range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A)
_SYMBOLS, _MARKS = b"#*$%&|<>", b".,;:?!'\"()-"


def features(text: str | None) -> np.ndarray:
    """The features of one whole text; an empty or NULL text has zeros."""
    data = (text or "").encode()
    out = np.zeros(len(FEATURES))
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), data.split(b"\n")
    n, size = max(1, len(words)), len(data)
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    distinct = len(set(words))
    out[:] = (
        np.log1p(size), np.log1p(len(words)), sum(map(len, words)) / n, upper / max(1, upper + lower),
        counts[_DIGIT].sum() / size, counts[list(_SYMBOLS)].sum() / size, counts[0x21] / size, counts[0x7C] / size,
        counts[list(_MARKS)].sum() / size, counts[0x80:].sum() / size, distinct / n, sum(map(bytes.istitle, words)) / n,
        min(200, max(map(len, words), default=0)), 1 - len(set(lines)) / len(lines), n / len(lines),
        1 - len(set(zip(words, words[1:], strict=False))) / max(1, n - 1), counts[0x20] / size)
    return out


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The values per bin of a greedy tree over ordered bins."""
    cuts = [0, len(gradient)]
    g, h = np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(weight))

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)

    while len(cuts) <= leaves:
        best, place = 1e-9, None
        for a, b in zip(cuts, cuts[1:], strict=False):
            inner = np.arange(a + 1, b)
            if len(inner):
                got = gain(a, inner) + gain(inner, b) - gain(a, b)
                if got.max() > best:
                    best, place = got.max(), int(inner[got.argmax()])
        if place is None:
            break
        cuts = sorted([*cuts, place])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes of a pair table: its gain and the values per cell."""
    def corners(x):
        low = np.cumsum(np.cumsum(x, 0), 1)[:-1, :-1]
        rows, columns, total = np.cumsum(x.sum(1))[:-1, None], np.cumsum(x.sum(0))[None, :-1], x.sum()
        return np.stack([low, rows - low, columns - low, total - rows - columns + low])

    if min(gradient.shape) < 2:
        return 0.0, np.zeros_like(gradient)
    g, h = corners(gradient), corners(weight)
    gains = (g ** 2 / (h + RIDGE)).sum(0)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    values = g[:, i, j] / (h[:, i, j] + RIDGE)
    out = np.empty_like(gradient)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gains.max()), out


@dataclass
class Model:
    """Lookup tables: ``intercept``, bin edges, a table per feature and per pair."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, values in enumerate(self.tables):
            total += values[np.searchsorted(self.edges[k], x[:, k], "right")]
        for i, j, values in self.pairs:
            total += values[np.searchsorted(self.pair_edges[i], x[:, i], "right"),
                            np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit by cyclic boosting. Without rows of both labels the score is their smoothed rate."""
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    model.pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * _tree(np.bincount(own, g, size), np.bincount(own, h, size))
            model.tables[k] += step
            logit += step[own]

    coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.pair_edges)]

    def cells(i, j, weights):
        shape = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], weights, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(((-_quadrants(cells(i, j, g), cells(i, j, h))[0], i, j)
                     for i in range(x.shape[1]) for j in range(i)))[:PAIRS]
    model.pairs = [(i, j, np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, values in model.pairs:
            g, h = slopes()
            step = RATE * _quadrants(cells(i, j, g), cells(i, j, h))[1]
            values += step
            logit += step[coarse[i], coarse[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> Model:
    """Fit on at most ``most`` labelled rows with crc32(doc_id) mod 3 other than 1."""
    def rows(batches):
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "x": [features(text) for text in batch["text"]]})

    known = examples(docs, labels, "quality", 3, 1, most)
    found = known.mapInPandas(rows, "y int, x array<double>").toPandas()  # at most ``most`` rows
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    y = found["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the order of arrival must not matter
    return fit(x[order], y[order])


def _scores(model):
    def score(batches):
        for batch in batches:
            x = np.array([features(text) for text in batch["text"]]).reshape(-1, len(FEATURES))
            yield batch.drop(columns="text").assign(score=model.value.score(x))
    return score


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row with an id, in no order.

    Only the text is scored, all of it; NULL counts as empty. Repeated rows get equal
    scores; an empty table gives an empty result; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most))  # a few KB of tables
    scored = texts(docs).mapInPandas(_scores(model), "doc_id long, score double")
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """The documents, all columns, whose text the classifier does not reject."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most))

    def good(column: pd.Series) -> pd.Series:
        x = np.array([features(text) for text in column]).reshape(-1, len(FEATURES))
        return pd.Series(model.value.score(x) >= 0.5)

    return docs.where(F.pandas_udf(good, "boolean")(F.col("text").cast("string")))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
