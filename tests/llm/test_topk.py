"""Exact top-k against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placewise.llm import queries, topk
from tests.llm.conftest import expected, rows


def plain(vectors, k=10):
    taken = [(i, vec_id, [max(-1 << 63, min((1 << 63) - 1, math.floor(1024 * x))) for x in v]) for i, (vec_id, v) in enumerate(vectors)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for row, vec_id, q in taken:
        if vec_id is None or vec_id % 100:
            continue
        scores = [(max(-1 << 63, min((1 << 63) - 1, sum(a * b for a, b in zip(q, v, strict=False)))), other) for r, other, v in taken if r != row]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        found += [(vec_id, rank + 1, other, score) for rank, (score, other) in enumerate(scores[:k])]
    return found


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in vectors], "vec_id long, embedding array<float>, label int, weights string, row double").repartition(3)


def exact(vectors):
    """As floats hold them."""
    import numpy as np
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]


def odd_vectors():
    rng = random.Random(2)
    vectors = [(i, [rng.choice([0.0, rng.uniform(-1, 1), 0.5]) for _ in range(8)]) for i in range(300)]
    vectors += [(300 + i, [0.25] * 8) for i in range(40)]  # ties
    vectors += [(400, None), (500, []), (600, [1.0]), (700, [0.1, None]), (800, [float("nan")] * 8), (900, [float("inf"), 1.0]), (None, [1.0] * 8),
                (1000, [0.0] * 8), (1000, [1.0] * 8), (1000, [1.0] * 8), (-100, [-1.0] * 9), (3, [0.5] * 8), (3, [0.5] * 8)]
    return exact(vectors)


@pytest.mark.parametrize("block, group", [(2048, 1024), (16, 3)])
def test_the_best_are_those_of_plain_python(spark, monkeypatch, block, group):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "GROUP_ROWS", group)
    monkeypatch.setattr(queries, "table", lambda *_: frame(spark, odd_vectors()))
    assert rows(queries.op12_exact_top_k(spark, "")) == expected(plain(odd_vectors()))


def test_sums_beyond_a_long_are_the_nearest_long(spark):
    vectors = exact([(0, [3e38, 3e38]), (1, [3e38, 1.0]), (2, [-3e38, 5.0]), (3, [1e12, -1e12]), (4, [1e12, 1e12]), (100, [1e9, 1e9])])
    assert rows(topk.top_k(frame(spark, vectors), F.col("vec_id") % 100 == 0)) == expected(plain(vectors))


def test_fewer_candidates_than_asked_for_and_none(spark):
    vectors = exact([(0, [1.0]), (1, [2.0]), (2, [2.0])])
    assert rows(topk.top_k(frame(spark, vectors), F.col("vec_id") == 0)) == [(0, 1, 1, 2048 * 1024), (0, 2, 2, 2048 * 1024)]
    assert rows(topk.top_k(frame(spark, vectors[:1]), F.col("vec_id") == 0)) == []
    assert rows(topk.top_k(frame(spark, vectors).limit(0), F.col("vec_id") == 0)) == []
    assert rows(topk.top_k(frame(spark, vectors), F.lit(None).cast("boolean"))) == []


def test_a_hot_vector_repeated_a_thousand_times(spark):
    vectors = exact([(i, [0.5, 0.5]) for i in range(3000)] + [(100_000, [1.0, 1.0])])
    found = rows(topk.top_k(frame(spark, vectors), F.col("vec_id").isin(0, 2999), k=3))
    assert found == expected([(0, 1, 100_000, 1024 * 1024), (0, 2, 1, 512 * 1024), (0, 3, 2, 512 * 1024),
                              (2999, 1, 100_000, 1024 * 1024), (2999, 2, 0, 512 * 1024), (2999, 3, 1, 512 * 1024)])
