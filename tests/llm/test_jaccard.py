"""Near-duplicate classes beside brute force."""

import random
import re

import numpy as np
import pytest
from helpers import as_dict, empty, table, with_clashes, words

from prepkit import session
from prepkit.llm import components as components_module
from prepkit.llm import jaccard_join as J
from prepkit.llm.components import components, joined
from prepkit.session import pin


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    best = [float("-inf") if i is None else i for i, _ in rows]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if (n := len(sets[a] & sets[b])) and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if best[a] != best[b]:
                best[a] = best[b] = min(best[a], best[b])
                changed = True
    return sorted(
        ((i, len(s), None if c == float("-inf") else c) for (i, _), s, c in zip(rows, sets, best, strict=True)), key=repr
    )


def near(rng, text, share):
    """A copy with a share of its words replaced, in one run and at single places."""
    w = text.split()
    for _ in range(max(1, int(len(w) * share / 5))):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    if rng.random() < 0.5:
        cut = rng.randint(0, len(w) // 10)
        w = w[cut:] if rng.random() < 0.5 else w[: len(w) - cut]
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    passage = " ".join(words(rng, 50))
    for _ in range(25):
        base = " ".join(words(rng, rng.choice([1, 4, 5, 7, 12, 30, 80, 200, 600])))
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            base = base if rng.random() < 0.5 else texts[-1]
            texts.append(base.upper() if rng.random() < 0.1 else near(rng, base, rng.choice([0.02, 0.1, 0.2, 0.3])))
    texts += [passage + " " + " ".join(words(rng, 14)) for _ in range(30)]
    texts += ["", None, " \t\n", texts[0], texts[0]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_beside_brute_force(spark, seed):
    texts = corpus(seed)
    ids = [None, *range(10, len(texts) + 9)]
    ids[7] = ids[8]
    got = sorted(map(tuple, J.link_classes(with_clashes(table(spark, texts, ids))).collect()), key=repr)
    assert got == brute(list(zip(ids, texts, strict=True)))


def test_blocks_and_common_shingles_change_nothing(spark, monkeypatch):
    texts = corpus(3)
    want = brute(list(enumerate(texts)))
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "COMMON_IN_RUN", 2)
    assert sorted(map(tuple, J.link_classes(table(spark, texts)).collect()), key=repr) == want


def test_many_near_copies_are_one_class(spark):
    rng = random.Random(5)
    base = " ".join(words(rng, 120))
    texts = [near(rng, base, 0.02) for _ in range(300)] + [base] * 100
    got = J.link_classes(table(spark, texts)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(enumerate(texts)))


def test_rounds_end_when_hardly_worth_it(spark, monkeypatch):
    rounds, one = [], J._round

    def noted(placed, known, sets, nearest):
        after, found, tried = one(placed, known, sets, nearest)
        rounds.append((nearest, found, tried))
        return after, found, tried

    monkeypatch.setattr(J, "_round", noted)
    texts = corpus(4)
    got = J.link_classes(table(spark, texts)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(enumerate(texts)))
    assert [n for n, *_ in rounds] == [True] * (len(rounds) - 1) + [False]
    assert rounds[-2][1] * J.WORTH < max(rounds[-2][2], 1)


def test_inner_tables_are_dropped(spark):
    before = set(session._pinned)
    J.link_classes(table(spark, corpus(7))).collect()
    left = [p.rsplit("/", 1)[1].split("-")[0] for p in session._pinned if p not in before]
    assert sorted(left) == ["base", "named"]


def test_one_of_each_class_stays(spark):
    texts = corpus(6)
    docs = table(spark, texts)
    want = {c for _, _, c in brute(list(enumerate(texts)))}
    kept = J.keep_one(docs.unionByName(docs.where("doc_id = 0")))
    assert kept.columns == docs.columns
    rows = as_dict(kept)
    assert set(rows) == want and kept.count() == len(want)
    assert all(r["text"] == texts[i] for i, r in rows.items())


def test_no_documents(spark):
    assert J.link_classes(empty(spark)).count() == 0
    assert J.keep_one(empty(spark)).count() == 0


def test_bounds_keep_every_similar_pair():
    rng = np.random.default_rng(1)
    sets = []
    for n in (3, 8, 40, 90, 300):
        for _ in range(12):
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            sets.append(base)
            sets.append(np.unique(np.concatenate((base[int(n * rng.random() * 0.15) :], rng.integers(0, 2**63, n // 12, dtype=np.uint64)))))
    nodes = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    cells = [J._point(s) for s in sets]
    got = {
        tuple(sorted(p))
        for a, b, _ in J.tree_pairs(sizes, nodes.copy(), cells, np.zeros(len(sets), int))
        for p in zip(a.tolist(), b.tolist(), strict=True)
    }
    similar = {
        (a, b)
        for a in nodes.tolist()
        for b in nodes.tolist()
        if a < b and 5 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 4 * (len(sets[a]) + len(sets[b]) - n)
    }
    assert similar and similar <= got
    assert len(got) < len(sets) * (len(sets) - 1) // 8
    best = {
        tuple(sorted(p))
        for a, b, _ in J.tree_pairs(sizes, nodes.copy(), cells, np.zeros(len(sets), int), nearest=True)
        for p in zip(a.tolist(), b.tolist(), strict=True)
    }
    assert best <= got and {k for p in got for k in p} == {k for p in best for k in p}


def test_pairs_have_a_tree_in_common():
    trees = [[5, 9], [9], [7], [5, 7], [2**62]]
    i, j = np.triu_indices(5, 1)
    want = [bool(set(trees[a]) & set(trees[b])) for a, b in zip(i, j, strict=True)]
    assert J._meet(J._flags(trees), i, j).tolist() == want


@pytest.mark.parametrize("part", [1 << 18, 20])
def test_components_of_chains_and_stars(spark, monkeypatch, part):
    monkeypatch.setattr(components_module, "PART", part)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 301)] * 2
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300}
    assert components(df.where("false")).count() == 0
    first = pin(components(df.where("a < 20 or a >= 200")))
    after = joined(first, df.unionByName(spark.createDataFrame([(301, 120)], df.schema)))
    want = {i: 0 for i in range(41)} | {k: 100 for k in [*range(100, 160), 300, 301]}
    assert {r["node"]: r["component"] for r in after.collect()} == want and after.count() == len(want)


def _sets_with_first(rng, n_sets):
    """Sets of shingles, near copies among them, and the trees of each: first shingles that others have too."""
    pool = rng.choice(2**62, 600, replace=False).astype(np.uint64)
    sets = []
    for _ in range(n_sets):
        base = rng.choice(pool[100:], int(rng.integers(5, 160)), replace=False)
        for _ in range(int(rng.integers(1, 4))):
            sets.append(np.unique(np.concatenate((base[int(len(base) * rng.random() * 0.15) :], rng.choice(pool[:100], 2)))))
    return sets


def test_sets_that_leave_their_largest_trees_still_meet(spark):
    sets = _sets_with_first(np.random.default_rng(3), 40)
    holders = {}
    for node, own in enumerate(sets):
        for h in own[: J._first_size(len(own))].tolist():
            holders.setdefault(h, []).append(node)
    rows = [(h, node) for h, nodes in holders.items() if len(nodes) > 1 for node in nodes]
    nodes = spark.createDataFrame([(k, len(s)) for k, s in enumerate(sets)], "node long, n long")
    members = spark.createDataFrame([(h - 2**61, node) for h, node in rows], "tree long, node long")
    found = J._trees(nodes, pin(members)).collect()
    held = {}
    for r in found:
        held.setdefault(r["node"], set()).add(r["tree"])
    similar = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if 5 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 4 * (len(sets[a]) + len(sets[b]) - n)
    ]
    assert len(similar) > 20 and all(held.get(a, set()) & held.get(b, set()) for a, b in similar)
    assert {r["tree"]: r["leader"] for r in found} == {t: min(r["node"] for r in found if r["tree"] == t) for t in {r["tree"] for r in found}}


def chance(seed, n):
    """Long texts that share single passages, each with a few of the others, and none of them similar."""
    rng = random.Random(seed)
    passages = [" ".join(words(rng, 6)) for _ in range(10 * n)]
    return [" ".join(" ".join(words(rng, 12)) + " " + rng.choice(passages) for _ in range(25)) for _ in range(n)]


def test_points_met_by_chance_stay_out_of_the_rounds(spark, monkeypatch):
    placed, one = [], J._round

    def noted(rows, known, sets, nearest):
        placed.append(rows.count())
        return one(rows, known, sets, nearest)

    monkeypatch.setattr(J, "_round", noted)
    texts = chance(8, 60)
    got = J.link_classes(table(spark, texts)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(enumerate(texts)))
    assert placed and not any(placed)
