"""Ranked search beside brute force, and the bounds beside exact scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import empty, table, with_clashes, words
from pyspark.sql import types as T

from prepkit.llm import bloom_search as B

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k=50):
    """``(item_id, rank, doc_id, score)`` of documents and items given as pairs."""
    counts = [(key, Counter(terms(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, -(10**30) if key is None else key, key))
        out += [(item, r, key, -s) for r, (s, _, key) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=50):
    df = B.search(with_clashes(table(spark, [t for _, t in docs], [i for i, _ in docs])), spark.createDataFrame(items, ITEMS), k)
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(rng, n, vocabulary):
    texts = []
    for k in range(n):
        size = rng.choice((0, 1, 3, 20, 200, 900))
        text = " ".join(f"{w}," if rng.random() < 0.1 else w for w in words(rng, size, rng.choice(vocabulary)))
        texts.append((k, texts[rng.randrange(k)][1] if k and rng.random() < 0.2 else text.title()))
    return texts


@pytest.mark.parametrize("k", [1, 5, 50])
def test_against_brute_force(spark, k):
    rng = random.Random(k)
    docs = corpus(rng, 150, (30, 400, 4000))
    items = [(i, " ".join(words(rng, rng.choice((1, 5, 30, 300)), 500))) for i in range(25)]
    assert found(spark, docs, items, k) == ranked(docs, items, k)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    docs = corpus(rng, 60, (30, 400))
    items = [(i, " ".join(words(rng, 12, 400))) for i in range(9)]
    monkeypatch.setattr(B, "ITEMS", 4)
    assert found(spark, docs, items) == ranked(docs, items)


def test_cases(spark):
    docs = [(5, None), (6, ""), (7, ".,; \n"), (8, "Été été 42"), (8, "other word"), (None, "été"), (3, "été"), (4, "ÉTÉ a1-b2 a1")]
    items = [(1, "été"), (1, "word"), (2, None), (3, "..."), (None, "A1 nothing"), (4, "absent")]
    assert found(spark, docs, items) == ranked(docs, items)


def test_ties_are_ranked_by_id(spark):
    docs = [(k, "same words here" if k % 2 else f"else {k}") for k in range(300, 0, -1)]
    got = found(spark, docs, [(1, "same"), (2, "else")], 7)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1] == [1, 3, 5, 7, 9, 11, 13]
    assert got == ranked(docs, [(1, "same"), (2, "else")], 7)


def test_very_long_text(spark):
    rng = random.Random(4)
    long = " ".join(words(rng, 900_000, 200_000))
    docs = [(0, long), (1, "w1 w2 w3"), (2, "w4 " * 300_000)]
    items = [(0, "w1 w2 w4"), (1, long[:20_000])]
    assert found(spark, docs, items) == ranked(docs, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a")], ITEMS)
    docs = table(spark, ["a b"])
    assert B.search(empty(spark), items).collect() == []
    assert B.search(docs, items.limit(0)).collect() == []
    assert B.search(docs.where("doc_id < 0"), items).collect() == []


def test_a_bound_is_never_below_the_score():
    rng = np.random.default_rng(5)
    n, width = 40, 256  # far too narrow, so that filters are full of false positives
    terms = np.unique(rng.integers(1, 2**63, 60, dtype=np.uint64))
    rows, which = np.nonzero(rng.random((n, len(terms))) < 0.4)
    tf = rng.integers(1, 40, len(rows))
    counts = np.bincount(rows, tf, n).astype(np.int64) + 3
    slices = B.sliced(width, rows, terms[which], tf, n)
    scoring = B.Scoring(rng.integers(0, 9000, len(terms)), n, int(counts.sum()))
    own = [np.sort(rng.choice(len(terms), 12, replace=False)) for _ in range(9)]
    bound = B.bounds(B.Items(list(range(9)), terms, own), scoring, width, counts, slices)
    added = np.zeros((n, len(terms)), np.int64)
    added[rows, which] = scoring.weights[which] * B.part_of(tf, scoring.lengths(counts)[rows])
    for i, mine in enumerate(own):
        assert (bound[i] >= added[:, mine].sum(axis=1)).all()


def test_bounds_exclude(spark):
    """With filters as wide as made, most documents that share no term with an item have a bound of 0."""
    rng = random.Random(9)
    docs = table(spark, [" ".join(words(rng, 100, 50_000)) for _ in range(400)])
    index = B.signatures(docs)
    block = B.Items([0], np.sort(np.random.default_rng(1).integers(1, 2**63, 8, dtype=np.uint64)), [np.arange(8)])
    excluded = total = 0
    for row in index.collect():
        counts = np.frombuffer(row["counts"], np.int64)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
        bound = B.bounds(block, B.Scoring(np.full(8, 1000), 400, 40_000), row["width"], counts, slices)
        excluded, total = excluded + (bound == 0).sum(), total + bound.size
    assert total == 400 and excluded > 0.75 * total
