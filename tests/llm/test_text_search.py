"""Passage dedup and decontamination beside brute force, and their defined cases."""

import hashlib
import random
import re

import pytest
from helpers import as_dict, empty, table, with_clashes, words

from prepkit.llm import decontaminate, substring_dedup


def passages(rng, docs):
    """Texts with shared passages of 10 to 60 words at any place."""
    pool = [words(rng, rng.randint(10, 60)) for _ in range(6)]
    texts = []
    for _ in range(docs):
        own = words(rng, rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(pool)
        texts.append(" ".join(own))
    return texts


def brute_dedup(rows):
    cut = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    rank = lambda i: float("-inf") if i is None else i
    for i, w in cut:
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            least[key] = min(least.get(key, float("inf")), rank(i))
    out = []
    for i, w in cut:
        gone = set()
        for p in range(len(w) - 12):
            if least[tuple(w[p : p + 13])] < rank(i):
                gone.update(range(p, p + 13))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_beside_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = passages(rng, 120) + ["", None, "one two", "x " * 500]
    rng.shuffle(texts)
    ids = [None, *range(1, len(texts))]
    ids[5] = ids[4]  # two rows of one id
    got = substring_dedup.remove_repeats(with_clashes(table(spark, texts, ids)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_dedup(list(zip(ids, texts, strict=True)))


def test_cover_has_all_differences():
    differences = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert differences == set(range(substring_dedup.PERIOD))


def test_dedup_of_nothing_and_of_copies(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    text = " ".join(words(random.Random(3), 30))
    got = as_dict(substring_dedup.remove_repeats(table(spark, [text] * 40), texts=True))
    assert got[0]["n_removed"] == 0 and got[0]["kept_text"] == text
    assert all(got[i]["n_removed"] == 30 and got[i]["kept_text"] == "" for i in range(1, 40))


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_leaks(rows, items):
    windows = []
    for item, text in items:
        w = letters(text)
        size = min(10, len(w))
        windows += [(str(item), w[p : p + size]) for p in range(len(w) - size + 1)] if size else []
    out = []
    for i, text in rows:
        w, hit, found = letters(text), set(), set()
        for item, part in windows:
            for p in range(len(w) - len(part) + 1):
                if w[p : p + len(part)] == part:
                    hit.update(range(p, p + len(part)))
                    found.add(item)
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [10**6, 7])
def test_leaks_beside_brute_force(spark, blocks):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, rng.choice([0, 3, 9, 10, 25])))) for k in range(12)]
    items += [(3, "Shared-id text, of its OWN eleven words: one two three four five"), (99, None)]
    texts = ["", None]
    for _ in range(60):
        own = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            part = (items[rng.randrange(12)][1] or "").split()[: rng.choice([9, 10, 14, 25])]
            at = rng.randint(0, len(own))
            own[at:at] = [x.upper() + "," for x in part]
        texts.append(" ".join(own))
    docs, bench = table(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(with_clashes(docs), bench, max_windows=blocks).collect()
    found = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got), key=repr)
    assert found == brute_leaks(list(enumerate(texts)), items)
    assert all(sum(b - a for a, b in zip(r["run_start"], r["run_end"], strict=True)) == r["n_hit"] for r in got)
    # Removing takes the hit words and nothing else.
    left = as_dict(decontaminate.remove_leaks(docs, bench, max_windows=blocks))
    for r in got:
        w = letters(texts[r["doc_id"]])
        gone = {p for a, b in zip(r["run_start"], r["run_end"], strict=True) for p in range(a, b)}
        assert letters(left[r["doc_id"]]["text"]) == [x for p, x in enumerate(w) if p not in gone]
        if not gone:
            assert left[r["doc_id"]]["text"] == texts[r["doc_id"]]


def test_leaks_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, ["a b c", None])
    assert [r["n_hit"] for r in decontaminate.find_leaks(docs, none).collect()] == [0, 0]
    assert decontaminate.remove_leaks(docs, none).count() == 2
    items = spark.createDataFrame([(None, "b")], "item_id long, text string")
    got = as_dict(decontaminate.find_leaks(docs, items))
    assert got[0]["items"] == ["null"] and got[0]["n_hit"] == 1 and got[1]["n_hit"] == 0
    assert decontaminate.find_leaks(empty(spark), items).count() == 0
