"""License notices beside a scan of every place."""

import random
import re

from helpers import as_dict, empty, table, with_clashes, words

from prepkit.llm import licenses as L


def shingles(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [tuple(w[p : p + 3]) for p in range(len(w) - 2)]


def brute(text, templates=L.TEMPLATES):
    """Spans of templates, by trying all templates in all windows of the text."""
    own, found = shingles(text), {}
    for name, template in templates.items():
        want = set(shingles(template))
        p = L.plan(len(want))
        for a in range(0, len(own), p.step * L.BLOCK):
            hit = [a + k for k, s in enumerate(own[a : a + p.window * L.BLOCK]) if s in want]
            if len({own[k] for k in hit}) >= L.CONTAINMENT * len(want):
                found.setdefault(name, []).append((hit[0], hit[-1] + 3))
    spans = []
    for name, cells in found.items():
        joined = []
        for a, b in sorted(cells):
            if joined and a < joined[-1][1]:
                joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
            else:
                joined.append((a, b))
        spans += [(name, a, b) for a, b in joined]
    return sorted(spans, key=lambda m: (m[1], m[0]))


def stretches(text):
    """Templates of which some stretch of their own length holds the asked share."""
    own = shingles(text)
    return {
        name
        for name, template in L.TEMPLATES.items()
        if any(
            len(want & set(own[p : p + len(want)])) >= L.CONTAINMENT * len(want)
            for want in [set(shingles(template))]
            for p in range(len(own))
        )
    }


def corpus(seed):
    rng = random.Random(seed)
    texts = ["", None, "two words", " ".join(words(rng, 3000))]
    names = sorted(L.TEMPLATES)
    for k in range(260):
        w = words(rng, rng.randint(0, 150))
        notice = L.TEMPLATES[names[k % len(names)]].split()
        if k % 3 == 0:
            notice[rng.randrange(len(notice))] = "changed"
        if k % 5 == 0:
            notice = notice[: len(notice) // 2]
        at = rng.randint(0, len(w))
        texts.append(" ".join(w[:at] + [x.upper() if k % 2 else x for x in notice] + w[at:]))
    return texts


def test_spans_are_those_of_brute_force(spark):
    texts = corpus(1)
    got = as_dict(L.scan(with_clashes(table(spark, texts))))
    for i, t in enumerate(texts):
        assert [tuple(m) for m in got[i]["matches"]] == brute(t)
    # No stretch of a template's length that holds enough of it is missed.
    wanted = [stretches(t) for t in texts]
    assert sum(map(len, wanted)) > 150
    assert all(w <= {m["template"] for m in got[i]["matches"]} for i, w in enumerate(wanted))


def test_neighbours_order_and_batches_change_nothing(spark):
    """The same rows, in other orders, other partitions and batches of other sizes."""
    texts = corpus(4)
    first = {i: r["matches"] for i, r in as_dict(L.scan(table(spark, texts))).items()}
    order = list(range(len(texts)))
    for size, parts in ((1, 3), (7, 1), (1000, 2)):
        random.Random(size).shuffle(order)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            again = as_dict(L.scan(table(spark, [texts[k] for k in order], order).coalesce(parts)))
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        assert {i: r["matches"] for i, r in again.items()} == first


def test_a_very_long_text(spark):
    rng = random.Random(6)
    notice = L.TEMPLATES["MIT-notice"]
    w = words(rng, 900_000, 50_000)
    w[700_000:700_000] = notice.split()
    got = as_dict(L.scan(table(spark, ["a b c", " ".join(w), notice])))
    spans = [(m["template"], m["start"], m["end"]) for m in got[1]["matches"]]
    assert got[1]["n_words"] > 900_000 and spans == [("MIT-notice", 700_000, 700_000 + len(notice.split()))]


def test_spans_hold_the_notice(spark):
    text = "aa bb cc " + L.TEMPLATES["CC-BY-NC-4.0"] + " dd ee ff"
    assert [tuple(m) for m in as_dict(L.scan(table(spark, [text])))[0]["matches"]] == [("CC-BY-NC-4.0", 3, 10)]


def test_a_notice_does_not_cross_rows(spark):
    first, last = "licensed under the apache", "license version 2 0"
    got = as_dict(L.scan(table(spark, [first, last, f"{first} {last}", f"{first} {last}"], [1, 2, 3, 3])))
    assert not got[1]["matches"] and not got[2]["matches"] and got[3]["matches"]
    assert L.scan(empty(spark)).count() == 0


def test_bands_reach_the_chance():
    for size in range(1, 400):
        p = L.plan(size)
        assert p.window * L.BLOCK >= size + p.step * L.BLOCK
        shared = -(-4 * size // 5)
        least = shared / (p.window * L.BLOCK + size - shared)
        assert 1 - (1 - least**p.rows) ** p.bands >= L.CHANCE


def test_notices_that_share_no_band_are_found(spark, monkeypatch):
    plan = L.plan
    monkeypatch.setattr(L, "plan", lambda *a: plan(*a)._replace(bands=1))
    texts = corpus(2)
    got = as_dict(L.scan(table(spark, texts)))
    assert all([tuple(m) for m in got[i]["matches"]] == brute(t) for i, t in enumerate(texts))


def test_every_index_has_the_same_factors():
    assert (L.TemplateIndex(L.TEMPLATES).factors == L.TemplateIndex(L.TEMPLATES).factors).all()


def test_whole_licenses_are_found(spark):
    rng = random.Random(3)
    templates = L.all_templates()
    bodies = {k: t for k, t in templates.items() if k not in L.TEMPLATES}
    assert {"MIT-text", "BSD-text", "Apache-2.0-text", "GPL-3-text", "LGPL-2.1-text", "MPL-2.0-text"} <= set(bodies)
    texts = []
    for t in bodies.values():
        w = t.split()
        for _ in range(len(w) // 80):
            w[rng.randrange(len(w))] = "changed"
        texts += [" ".join(words(rng, 90) + w + words(rng, 90)), " ".join(w[: len(w) // 2])]
    got = as_dict(L.scan(table(spark, texts), templates))
    for k, name in enumerate(bodies):
        assert name in {m["template"] for m in got[2 * k]["matches"]}
        assert name not in {m["template"] for m in got[2 * k + 1]["matches"]}
