"""Nearest vectors beside brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.llm import impact_search as I

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector]


def nearest(rows, k=5, every=50):
    """``(query_id, rank, vec_id, score)`` by all pairs."""
    kept = [(n, key, whole(v)) for n, (key, v) in enumerate(rows) if whole(v) is not None]
    out = []
    for n, query, q in kept:
        if query is None or query % every:
            continue
        scores = []
        for other, key, v in kept:
            if other != n:
                score = sum(a * b for a, b in zip(q, v, strict=False))
                scores.append((-min(max(score, -(2**63) + 1), 2**63 - 1), -(10**30) if key is None else key, key))
        out += [(query, r, key, -s) for r, (s, _, key) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, k=5, every=50, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("key", "asked", "number", "values", "rank", "score"):
        df = df.withColumn(name, F.lit("other"))
    got = I.nearest(df, F.col("vec_id") % every == 0, k)
    return sorted((tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def vectors(rng, n, width, spread=0.3):
    centres = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(4)]
    return [(k, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for k in range(n)]


@pytest.mark.parametrize(("width", "k", "parts"), [(1, 5, 1), (3, 1, 2), (16, 5, 3), (64, 40, 7)])
def test_against_brute_force(spark, width, k, parts):
    rows = vectors(random.Random(width), 300, width)
    assert found(spark, rows, k, parts=parts) == nearest(rows, k)


def test_ties_equal_vectors_and_repeated_ids(spark):
    rows = [(k, [0.5, -0.25]) for k in range(200)] + [(50, [0.5, -0.25]), (50, [0.5, 0.1]), (7, [1.0, 0.0])]
    assert found(spark, rows) == nearest(rows)


def test_cases(spark):
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]),
        (250, []), (300, [0.0, 0.0]), (None, [3.0, 3.0]), (-50, [-1.0, 0.5, 7.0]), (1, [0.003, -0.003]), (2, [1e307, 0.0]),
    ]
    assert found(spark, rows) == nearest(rows)
    assert found(spark, rows[:1]) == []


def test_great_numbers(spark):
    rows = [(k, [(-1) ** k * 3.0e7 * k, 2.0**40 + k, 1e17 * (k % 3)]) for k in range(0, 300, 7)]
    assert found(spark, rows, every=7) == nearest(rows, every=7)


def test_empty_table_and_no_query(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_a_very_long_vector(spark):
    rng = random.Random(2)
    rows = [(k, [rng.random() for _ in range(30_000)]) for k in (0, 1, 2, 3)]
    assert found(spark, rows) == nearest(rows)


def test_blocks_of_queries_give_the_same(spark, monkeypatch):
    rows = vectors(random.Random(8), 200, 8)
    monkeypatch.setattr(I.query_blocks, "__defaults__", (1,))
    assert found(spark, rows) == nearest(rows)


def test_most_rows_are_excluded_by_proof():
    """With clusters, a small share of a block is left for exact scores, and it holds the best."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 60, (20, 32))
    values = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 8, (4000, 32)))
    rows, edges = I.segments_of(values)
    cells = [np.arange(4000), np.zeros(4000, bool), values, rows, edges]
    block = I.Block(0, 32, *(c.tobytes() for c in cells))
    for n in range(0, 4000, 400):
        left, scores = block.search(values[n], n, 5, I.NONE)
        exact = values @ values[n]
        exact[n] = -np.inf
        best = np.lexsort((np.arange(4000), -exact))[:5]
        assert set(best) <= set(left) and len(left) < 1000
        assert (scores == exact[left]).all()
