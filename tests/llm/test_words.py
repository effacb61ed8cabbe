"""Word arrays beside plain Python."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from prepkit.llm import exchange as X
from prepkit.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z\t\n\x0b\x1c0é漢😀_.", max_size=40)), max_size=8)
CLASSES = [
    (W.NOT_SPACE, W.AS_IS, r"[^\x20\x09-\x0D]+", lambda t: t),
    (W.LETTERS, W.LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)),
]


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_windows(texts, limit):
    for is_word, fold, pattern, folded in CLASSES:
        by_hash: dict[int, str] = {}
        rows = 0
        for chunk in W.chunks(pa.array(texts, pa.string()), limit):
            found = W.find_words(chunk, is_word, fold)
            for r in range(chunk.high - chunk.low):
                own = slice(found.first[r], found.first[r + 1])
                got = [folded(chunk.text(a, b)) for a, b in zip(found.start[own], found.end[own], strict=True)]
                want = re.findall(pattern, folded(texts[chunk.low + r] or ""))
                assert got == want
                for h, w in zip(found.hash[own].tolist(), want, strict=True):
                    assert by_hash.setdefault(h, w) == w
                place, hashes = W.row_windows(found, 2)
                here = hashes[found.row[place] == r]
                assert len(here) == max(0, len(want) - 1)
            rows += chunk.high - chunk.low
        assert rows == len(texts)
        assert len(set(by_hash.values())) == len(by_hash)


def test_a_word_longer_than_a_block_has_the_hash_of_its_bytes():
    long = "x" * (W.BLOCK_BYTES + 5)
    chunk = next(W.chunks(pa.array([f"a {long} b {long}"])))
    found = W.find_words(chunk)
    assert len(found.hash) == 4 and found.hash[1] == found.hash[3] and len(set(found.hash.tolist())) == 3


def test_windows_differ_by_order_and_size():
    h = np.arange(1, 7, dtype=np.uint64)
    assert len(set(W.windows(h, 2).tolist()) | set(W.windows(h[::-1], 2).tolist())) == 10
    assert W.windows(np.zeros(5, np.uint64), 2)[0] != W.windows(np.zeros(5, np.uint64), 3)[0]


def test_covered_and_runs():
    flags = W.covered(np.array([1, 2, 7]), 3, 10)
    assert flags.tolist() == [False, True, True, True, True, False, False, True, True, True]
    assert [x.tolist() for x in W.runs(flags)] == [[1, 7], [5, 10]]


def test_packing_cells():
    h = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    assert X.unpacked(X.packed(h)).tolist() == h.tolist()


def test_shared_hashes_beside_sets(spark, monkeypatch):
    monkeypatch.setattr(X, "RUN", 64)
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 300, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = rng.integers(0, 900, 4000)
    hashes[:1500] = 7  # a third of all rows hold one hash
    df = spark.createDataFrame([(int(k), int(h.view(np.int64))) for k, h in zip(keys, hashes, strict=True)], "k long, h long")

    def entries(batch):
        yield batch.column(1).to_numpy().view(np.uint64), batch.column(0).to_numpy()

    owners: dict[int, set[int]] = {}
    for k, h in zip(keys.tolist(), hashes.tolist(), strict=True):
        owners.setdefault(h, set()).add(k)
    for later in (False, True):
        got = {(r["key"], h) for r in X.shared_hashes(df, entries, 16, later).collect() for h in X.unpacked(r["hashes"]).tolist()}
        want = {(k, h) for h, own in owners.items() if len(own) > 1 for k in own if not later or k > min(own)}
        assert got == want


def test_windows_of_long_columns_take_bounded_memory():
    """Besides the column, a task holds the arrays of one chunk at a time."""
    rng = random.Random(5)
    texts = pa.array([" ".join(f"w{rng.randrange(10**5)}" for _ in range(1000)) for _ in range(1000)])
    tracemalloc.start()
    try:
        for chunk in W.chunks(texts):
            W.row_windows(W.find_words(chunk, W.LETTERS, W.LOWER), 10)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
