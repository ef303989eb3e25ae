"""Exact top-k search by branch and bound over columns.

Every query is searched against every row. A unit of work is a block of queries and a share
of the rows. Rows stream through it in slices held column by column. Products are summed up
a block of dimensions at a time, those with the largest share of the queries' mass first;
after each block a row stays only if its sum so far and the most that the remaining masses
of both vectors allow reach the query's k-th score so far. What stays is compacted, so
later dimensions are read for few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, stored, table, tasks_for

K = 10
EVERY = 100
SCALE = 1024

# Queries of a block, rows of a slice, and dimensions whose products are added at a time.
QUERY_BLOCK = 2048
SLICE = 1024
DIMENSIONS = 16

_EXACT = 2.0 ** 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def integer_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, values`` with every component ``x`` as ``floor(1024 * x)``.

    Rows without an id or vector, or with a component that is NULL or not finite, go.
    """
    finite: Column = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(finite).select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE)))).alias("values"))


class Search:
    """The best ``k`` rows so far of each query of one block; all vectors of one length."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.k = rows, ids, k
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        weight = (vectors.astype(np.float64) ** 2).sum(axis=0)
        self.order = np.argsort(-weight, kind="stable")
        self.whole = vectors
        self.vectors = vectors[:, self.order].astype(np.float64)
        self.cuts = [*range(0, vectors.shape[1], DIMENSIONS), vectors.shape[1]]
        self.rest = self._rest(self.vectors)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.least = np.full(len(ids), -np.inf)
        self.entered = [0] * len(self.cuts)

    def _rest(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector, the length of what is left behind each cut."""
        return np.stack([np.sqrt((vectors[:, cut:] ** 2).sum(axis=1)) for cut in self.cuts])

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        for low in range(0, len(ids), SLICE):
            part = slice(low, low + SLICE)
            self._slice(rows[part], ids[part], vectors[part])

    def _slice(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        # abs of the least long is itself, so the size is taken of floats.
        size = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        if max(1, vectors.shape[1]) * max(1.0, size) * max(1.0, self.largest) >= _EXACT:
            scores = self.whole.astype(object) @ vectors.T.astype(object)
            for i in range(len(self.ids)):
                self._offer(i, rows, ids, np.clip(scores[i], _LEAST, _MOST).astype(np.int64))
            return
        columns = np.ascontiguousarray(vectors[:, self.order].T).astype(np.float64)
        rest = self._rest(columns.T)
        first = min(1, len(self.cuts) - 1)  # vectors without components have no blocks
        sums = self.vectors[:, :self.cuts[first]] @ columns[:self.cuts[first]]
        # Sums are whole numbers below 2 ** 53; the bound is raised by more than its rounding.
        stay = sums + self.rest[first][:, None] * rest[first] * (1 + 1e-9) + 1e-6 >= self.least[:, None]
        self.entered[0] += stay.size
        for i in np.flatnonzero(stay.any(axis=1)).tolist():
            left = np.flatnonzero(stay[i])
            score = sums[i, left]
            for cut in range(first, len(self.cuts) - 1):
                self.entered[cut] += len(left)
                block = slice(self.cuts[cut], self.cuts[cut + 1])
                score = score + self.vectors[i, block] @ columns[block, left]
                keep = score + self.rest[cut + 1][i] * rest[cut + 1][left] * (1 + 1e-9) + 1e-6 >= self.least[i]
                left, score = left[keep], score[keep]
            if len(left):
                self._offer(i, rows[left], ids[left], score.astype(np.int64))

    def _offer(self, i: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rows with their scores for query ``i``; its own row is none of them."""
        other = rows != self.rows[i]
        scores = np.concatenate([self.best[i][0], scores[other]])
        names = np.concatenate([self.best[i][1], ids[other]])
        if len(scores) > self.k:
            top = scores >= np.partition(scores, -self.k)[-self.k]
            scores, names = scores[top], names[top]
        order = np.lexsort((names, ~scores))[:self.k]
        self.best[i] = scores[order], names[order]
        if len(order) == self.k:
            self.least[i] = scores[order[-1]]

    def results(self) -> Iterator[tuple[int, int, int, int]]:
        for row, name, (scores, ids) in zip(self.rows.tolist(), self.ids.tolist(), self.best):
            for score, other in zip(scores.tolist(), ids.tolist()):
                yield row, name, other, int(score)


def _by_length(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    sizes = frame["values"].map(len)
    for size, part in frame.groupby(sizes, sort=False):
        vectors = np.concatenate(part["values"].tolist()) if size else np.zeros(0)
        yield size, part["row"].to_numpy(), part["vec_id"].to_numpy(), vectors.astype(np.int64).reshape(len(part), size)


def _units(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held, searches = None, [], {}

        def end() -> pd.DataFrame:
            return pd.DataFrame([r for s in searches.values() for r in s.results()],
                                columns=["row", "query_id", "vec_id", "score"])

        for batch in batches:
            for number, part in batch.groupby("unit", sort=False):
                if number != unit:
                    yield end()
                    unit, held, searches = number, [], {}
                queries = part[part["kind"] == 0]
                if len(queries):
                    held.append(queries)
                rows = part[part["kind"] == 1]
                if len(rows):
                    if held:  # all queries of a unit come before its rows
                        searches = {size: Search(*q, k) for size, *q in _by_length(pd.concat(held))}
                        held = []
                    for size, *found in _by_length(rows):
                        if size in searches:
                            searches[size].add(*found)
        yield end()

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows with the largest inner products.

    ``vectors`` has ``vec_id, values``; rows for which ``queries`` is true are searched, each
    against all rows but itself. Equal scores go to the smaller id; fewer rows give fewer
    ranks. Only vectors of one length are compared. Rows that repeat an id are rows of their
    own, also as queries. Scores beyond a long are shown as its ends, components too.
    """
    # Rows get their numbers once: the file is read again, not the frame.
    numbered = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = numbered.where(queries)
    blocks = max(1, -(-asked.count() // query_block))
    shares = max(1, -(-2 * tasks_for(numbered) // blocks))
    number = F.xxhash64("row")
    block, share = F.pmod(number, F.lit(blocks)), F.pmod(F.xxhash64(number), F.lit(shares))
    # A block of queries meets each share of the rows in one unit: no row pairs are made.
    asked = asked.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(
        "*", (block * shares + F.col("other")).alias("unit"), F.lit(0).alias("kind"))
    rows = numbered.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "*", (F.col("other") * shares + share).alias("unit"), F.lit(1).alias("kind"))
    both = asked.unionByName(rows).repartition(blocks * shares, "unit").sortWithinPartitions("unit", "kind")
    found = both.select("unit", "kind", "row", "vec_id", "values").mapInPandas(
        _units(k), "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_SQL = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= {K}"""


@query("op12_topk_search", _SQL)
def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % EVERY == 0)
