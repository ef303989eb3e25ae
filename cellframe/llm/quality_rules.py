"""Quality rules and a hashed n-gram log-likelihood ratio against a trusted target.

Words and word pairs of a text are hashed into ``BUCKETS``. Two multinomials over the
buckets are estimated with add-one smoothing: one from all documents, one from all
trusted rows (quality 1). The score of a text is the mean logarithm
of the ratio of its buckets' probabilities, so it does not depend on length; texts at
``THRESHOLD`` or above are kept, unless a base rule fails them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mixed, query, table, texts, word_hashes

BUCKETS = 1 << 16
THRESHOLD = -0.15  # mean natural logarithm per n-gram
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACES, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes[:-1] * _STEP + hashes[1:])


def grams(hashes: np.ndarray) -> np.ndarray:
    """The buckets of all words and word pairs, given the words' hashes."""
    return (np.concatenate((hashes, _pairs(hashes))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def repeat_words(hashes: np.ndarray) -> int:
    """How many words lie in a 3-word window that occurs twice or more."""
    if len(hashes) < 4:
        return 0
    windows = mixed(_pairs(hashes)[:-1] * _STEP + hashes[2:])
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(hashes), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def base_counts(text: str, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text."""
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (len(hashes), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(hashes))


def packed(buckets: np.ndarray) -> bytes:
    """Bucket numbers as the differences of their sorted order, seven bits a byte."""
    steps = np.diff(np.sort(buckets), prepend=0)
    out = np.empty((len(steps), 3), np.uint8)  # BUCKETS needs at most 17 bits
    used = np.ones((len(steps), 3), bool)
    for k in range(3):
        left = steps >> (7 * k)
        out[:, k] = (left & 127) | np.where(left >> 7 > 0, 128, 0)
        used[:, k] = (left > 0) | (k == 0)
    return out[used].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The sorted bucket numbers again."""
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.cumsum(np.add.reduceat((raw & 127) << (7 * place), starts)) if len(ends) else ends


def _summed(counts: DataFrame) -> np.ndarray:
    """All tasks' counts of buckets: one row per bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gram_counts(docs: DataFrame) -> np.ndarray:
    """How many n-grams of all texts fall in each bucket: a task sends at most one row per bucket."""
    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, grams(word_hashes((text or "").encode())), 1)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit, "n": total[hit]})

    return _summed(docs.select("text").mapInPandas(count, "bucket long, n long"))


def trusted_counts(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """The same for the rows whose id is among ``ids``.

    Not the texts are joined with the ids, but each text's packed bucket numbers. The join
    is by sorting at every size, so it grows with the input alone.
    """
    def pack(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "buckets": [
                packed(grams(word_hashes((text or "").encode()))) for text in batch["text"]]})

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data in batch["buckets"]:
                np.add.at(total, unpacked(data), 1)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit, "n": total[hit]})

    narrow = docs.mapInPandas(pack, "doc_id long, buckets binary")
    trusted = narrow.join(ids.hint("merge"), "doc_id", "left_semi")
    return _summed(trusted.select("buckets").mapInPandas(count, "bucket long, n long"))


def log_ratios(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """The logarithm of the ratio of both probabilities, per bucket; zero without a target."""
    if not target.sum():
        return np.zeros(len(corpus))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((corpus + 1) / (corpus.sum() + len(corpus)))


def apply_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, score and verdict for every row with an id.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score``. NULL and empty texts have no words, fail and score 0. Without trusted rows
    every score is 0 and the base rules decide. Repeated rows get equal results; an
    empty table gives an empty result; other columns are ignored.
    """
    docs = texts(docs)
    known = labels.where("quality = 1").select(F.col("doc_id").cast("bigint")).distinct()
    target, corpus = trusted_counts(docs, known), gram_counts(docs)
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(target, corpus))  # BUCKETS numbers

    def rate(batches):
        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text or ""
                hashes = word_hashes(text.encode())
                own = grams(hashes)
                rows.append((*base_counts(text, hashes), float(ratios.value[own].mean()) if len(own) else 0.0))
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=columns)], axis=1)

    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    rated = docs.mapInPandas(rate, "doc_id long, " + ", ".join(f"{c} long" for c in columns[:-1]) + ", score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rated.select("doc_id", *columns[:-1], failed.alias("base_failed"),
                        (~failed & (F.col("score") >= threshold)).alias("kept"), "score")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
