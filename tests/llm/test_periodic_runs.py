"""Periodic runs beside brute force over all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import as_dict, empty, table, with_clashes, words

from prepkit.llm import periodic_runs as R
from prepkit.llm.queries import op11_periodic_runs, with_planted_runs


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def all_runs(w):
    """Every run, by trying every lag and every place."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def repetitive(rng):
    """Texts of few words, with runs of all kinds: nested, adjacent, overlapping, cut short."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        part = [f"v{rng.randrange(rng.choice((1, 2, 3, 30)))}" for _ in range(rng.randrange(1, 12))]
        out += part * rng.randrange(1, 9) + part[: rng.randrange(len(part) + 1)]
        if rng.random() < 0.3:
            out += words(rng, rng.randrange(5), 50)
    if rng.random() < 0.3:
        out = out * 2 + out[:3]
    return out


def test_lag_scan_finds_every_run():
    rng = random.Random(5)
    for _ in range(400):
        w = repetitive(rng)
        names = {x: k for k, x in enumerate(dict.fromkeys(w))}
        ids = np.array([names[x] for x in w], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        assert R.lag_scan(ids) == all_runs(w)


def test_splitting_keeps_runs_and_ends_with_words_met_twice(spark):
    rng = random.Random(6)
    texts = [words(rng, 200, 120) + repetitive(rng) + words(rng, 100, 90) for _ in range(60)]
    got = R.collapse_runs(table(spark, [" ".join(w) for w in texts])).collect()
    for row in got:
        w = texts[row["doc_id"]]
        runs = all_runs(w)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == runs
        assert row["collapsed"] == collapsed(w, runs) and row["n_words"] == len(w)


def test_segments_are_stable():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 40, 500)
    first = np.array([0, 200, 200, 500])
    last, following = np.full(500, -1), np.full(500, 500)
    for a, b in ((0, 200), (200, 500)):
        for i in range(a, b):
            same = [j for j in range(a, b) if ids[j] == ids[i]]
            last[i] = max([j for j in same if j < i], default=-1)
            following[i] = min([j for j in same if j > i], default=500)
    for low, high in zip(*R.segments(first, last, following), strict=True):
        assert high - low >= R.LEAST
        assert np.unique(ids[low:high], return_counts=True)[1].min() >= 2


CASES = [
    None, "", " \t\n", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a", "x y " * 12, "é\n" * 30,
    "a b c d e f g " * 2, "a b c d e f " * 2, "a b c d e f " * 2 + "a a a a a a a a a a a a a",
]


def test_cases(spark):
    got = as_dict(R.collapse_runs(with_clashes(table(spark, CASES))))
    for k, text in enumerate(CASES):
        w = spaced(text)
        runs = all_runs(w)
        assert [tuple(r) for r in got[k]["runs"]] == runs and got[k]["collapsed"] == collapsed(w, runs)
    assert got[4]["runs"] == [] and len(got[5]["runs"]) == 1 and got[0]["collapsed"] == ""


def test_ties_repeated_rows_and_null_ids(spark):
    two = "a b " * 6 + "x " + "c d " * 6
    df = table(spark, [two, two, "a " * 12], [7, 7, None]).withColumn("longest", R.F.lit(1))
    got = R.collapse_runs(df).withColumn("best", R.longest_run()).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == ["7", "7", "None"]
    for row in got:
        assert row["best"]["start"] == 0 and row["best"]["length"] == 12


def test_empty_table(spark):
    assert R.collapse_runs(empty(spark)).collect() == []


@pytest.mark.parametrize("part", [1, 7, 30_000])
def test_very_long_text(spark, part):
    """Over four megabytes in one text, scanned whole."""
    rng = random.Random(part)
    w = words(rng, part, 10**6)
    text = " ".join(words(rng, 1000, 10**6) + ["begin"] + w * (700_000 // part) + ["end"])
    row = R.collapse_runs(table(spark, [text, "a"])).where("doc_id = 0").first()
    assert [tuple(r) for r in row["runs"]] == [(1001, 700_000 // part * part, part)]
    assert row["collapsed"].split()[1000:] == ["begin", *w, "end"]


def test_query_beside_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(repetitive(rng) if k % 3 else words(rng, rng.randrange(300), 100)) for k in range(150)]
    texts += [None, "", "one", " lead\ttabs\x0b and\n\nlines "]
    df = table(spark, texts, [3 * k - 50 for k in range(len(texts))])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = as_dict(op11_periodic_runs(spark, str(tmp_path)))
    rewritten = as_dict(with_planted_runs(df))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    hit = 0
    for k, text in enumerate(texts):
        key = 3 * k - 50
        w = planted(key, spaced(text))
        hit += w != spaced(text)
        assert spaced(rewritten[key]["text"]) == w
        runs = all_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = got[key]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row["collapsed_sha256"] == sha(collapsed(w, runs))
    assert hit > 5
