"""Top-k search against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.llm import topk_search as tk


def expected(rows, k, every):
    numbers = []
    for place, (name, vector) in enumerate(rows):
        if name is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            numbers.append((place, name, [max(-(1 << 63), min((1 << 63) - 1, math.floor(1024 * x))) for x in vector]))
    out = []
    for place, name, own in numbers:
        if name % every == 0:
            scores = [(sum(a * b for a, b in zip(own, v)), other) for p, other, v in numbers if p != place and len(v) == len(own)]
            scores = [(max(-(1 << 63), min((1 << 63) - 1, s)), other) for s, other in scores]
            out += [(name, rank, other, s) for rank, (s, other) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return sorted(out)


def found(spark, rows, k, every, block=2048):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, values string, row int")
    got = tk.top_k(tk.integer_vectors(frame), F.col("vec_id") % every == 0, k, block)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [2048, 7])
def test_search_equals_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(tk, "SLICE", 64)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(700, 40)).astype(np.float32)
    vectors[:300] = vectors[0]  # many ties
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    assert found(spark, rows, 10, 20, block) == expected(rows, 10, 20)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [1.0]), (2, []), (4, []), (6, None), (8, [None, 1.0]), (10, [float("nan"), 1.0]),
            (12, [float("inf"), 1.0]), (None, [3.0, 3.0]), (14, [3.0, 3.0]), (15, [-0.0001, 0.5]), (16, [3e38, -3e38]),
            (18, [3e38, 3e38]), (20, [1.0, 2.0, 3.0]), (-2, [0.25, 0.25])]
    assert found(spark, rows, 3, 2) == expected(rows, 3, 2)
    assert found(spark, [], 3, 2) == []


def test_rows_are_left_out_by_bounds(monkeypatch):
    """Few rows reach the last block of dimensions once good ones have been seen."""
    rng = np.random.default_rng(1)
    scale = np.linspace(1, 0.02, 64) ** 2
    vectors = np.floor(1024 * rng.normal(size=(6000, 64)) * scale).astype(np.int64)
    search = tk.Search(np.arange(40), np.arange(40), vectors[:40], 10)
    search.add(np.arange(6000), np.arange(6000), vectors)
    assert search.entered[0] == 40 * 6000
    assert search.entered[-2] < 0.3 * search.entered[0]
    got = {(name, other): score for _, name, other, score in search.results()}
    scores = vectors[:40] @ vectors.T
    for name in range(40):
        best = sorted((-int(s), k) for k, s in enumerate(scores[name]) if k != name)[:10]
        assert {k: -s for s, k in best} == {other: s for (n, other), s in got.items() if n == name}
