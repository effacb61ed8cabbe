"""Host-aware quality rules beside plain Python."""

import random
import re
from collections import Counter

import pytest
from helpers import SCHEMA, as_dict, empty, with_clashes, words
from prepkit import session
from prepkit.llm import host_quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[p : p + 8]) for p in range(len(w) - 7)]
    many = {x for x, n in Counter(windows).items() if n > 1}
    covered = {q for p, x in enumerate(windows) if x in many for q in range(p, p + 8)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)
    )


def texts(seed):
    rng = random.Random(seed)
    out = ["", None, "\n \n\t", "one", "a b " * 300, "same line here\n" * 40, "é漢 😀 " * 30, "x" * 5000 + " y"]
    for _ in range(80):
        w = words(rng, rng.randint(0, 120), 60)
        for _ in range(rng.randint(0, 4)):
            at, to = rng.randint(0, len(w)), rng.randint(0, len(w))
            w[to:to] = w[at : at + rng.randint(1, 30)]
        out.append("".join(x + rng.choice([" ", " ", "  ", "\n", "\t", " | ", "### "]) for x in w))
    return out


def test_measures(spark):
    rows = [(i, t, "en", f"h{i % 3}", 0) for i, t in enumerate(texts(1))]
    got = Q.measure(with_clashes(spark.createDataFrame(rows, SCHEMA)), carried=["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    found = {r["row"]["doc_id"]: tuple(r[n] for n in names) for r in got.collect()}
    assert found == {i: brute(t) for i, t, *_ in rows}


def clean(rng):
    return " ".join(f"word{rng.randrange(10**6)}" for _ in range(60))


def junk(rng):
    return " ".join(f"word{rng.randrange(10**6)} ### |" for _ in range(60))


@pytest.fixture(scope="module")
def hosts(spark):
    """A host of junk, one of a third of all rows with little, one without, one of null, and a one-row host."""
    rng = random.Random(2)
    rows = []
    for host, n, bad in (("bad", 60, 50), ("hot", 200, 20), ("good", 150, 1), (None, 60, 6), ("tiny", 1, 1)):
        rows += [(len(rows) + k, junk(rng) if k < bad else clean(rng), "en", host, 1) for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_verdicts_and_clean_documents(hosts):
    verdict = {r["host"]: r for r in Q.host_verdicts(Q.measure(hosts)).collect()}
    assert verdict["bad"]["verdict"] == "bad" and verdict["good"]["verdict"] == "trusted"
    assert verdict["hot"]["verdict"] == verdict[None]["verdict"] == "usual"
    # One failing document does not condemn its host: the rate is shrunk from 1 towards the others.
    assert verdict["tiny"]["rate"] < 0.9
    assert verdict["hot"]["n_docs"] == 200 and verdict["hot"]["n_failed"] == 20
    kept = Q.keep_good(hosts)
    assert kept.columns == hosts.columns
    left = as_dict(kept)
    for r in hosts.collect():
        if "###" not in r["text"] or r["source"] == "good":
            assert left[r["doc_id"]] == r
        else:
            assert r["doc_id"] not in left


def test_base_rule_holds_on_any_host(spark, hosts):
    more = spark.createDataFrame([(9000, "few words", "en", "good", 1), (9001, "a b c d e f g h " * 9, "en", "good", 1)], SCHEMA)
    judged = {r["row"]["doc_id"]: r for r in Q.judge(hosts.unionByName(more)).collect()}
    assert judged[9000]["base_failed"] and judged[9001]["base_failed"]
    assert not judged[9000]["kept"] and not judged[9001]["kept"]


def test_a_bad_host_is_held_to_stricter_limits(spark, hosts):
    """A document between the two limits stays on a usual host and goes from a bad one."""
    rng = random.Random(3)
    between = " ".join(f"word{rng.randrange(10**6)}" + (" #" if k % 7 == 0 else "") for k in range(70))
    rows = [(9000 + k, between, "en", host, 1) for k, host in enumerate(("bad", "hot", "good", None))]
    left = as_dict(Q.keep_good(hosts.unionByName(spark.createDataFrame(rows, SCHEMA))))
    assert {k for k in left if k >= 9000} == {9001, 9002, 9003}


def test_no_text_is_stored(hosts):
    before = set(session._pinned)
    assert Q.keep_good(hosts).count()
    left = [p for p in session._pinned if p not in before]
    assert [p.rsplit("/", 1)[1].split("-")[0] for p in left] == ["verdicts"]


def test_empty_and_repeated(spark, hosts):
    assert Q.judge(empty(spark)).count() == 0
    twice = hosts.unionByName(hosts)
    assert Q.keep_good(twice).count() == 2 * Q.keep_good(hosts).count()


def test_measures_are_taken_once_where_rows_are_kept(hosts):
    """The filter stays above the measures; below them it would repeat them for each of its parts."""
    plan = Q.keep_good(hosts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2 and not re.search("Python|Arrow|Pandas", plan)


def test_no_python_in_the_plan(hosts):
    plan = Q.measure(hosts)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
