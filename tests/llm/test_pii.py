"""Personal data: base patterns beside Python's re, the label model, and masking."""

import random
import re

import numpy as np
from helpers import as_dict, empty, table, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from prepkit.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def good(kind, cell):
    digits = re.sub("[^0-9]", "", cell)
    if kind == "ip":
        return all(int(p) <= 255 for p in cell.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), list(BASE).index(kind), m.end())
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text)
        if good(kind, m.group())
    ]
    return [(list(BASE)[k], a, b) for a, k, b in sorted(found)]


PIECES = st.sampled_from(
    ["a", "b.c", "@", "@x.y", "a@b.co", ".", "_", "-", " ", "1.2.3.4", "256.1.1.1", "00.0.0.00", "4111 1111 1111 1111",
     "4111111111111112", "+1 (714) 555-9345", "+", "(", ")", "12", "3", "é", "\n", "555-12-3456", "joe [at] mail [dot] com"]
)


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=14))
def test_base_spans(pieces):
    text = "".join(pieces)
    assert [(s.kind, s.start, s.end) for s in pii.spans(text) if s.base] == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123 -.+()@aB_", max_size=60))
def test_base_spans_of_any_text(text):
    assert [(s.kind, s.start, s.end) for s in pii.spans(text) if s.base] == brute(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a." * 150_000 + "@", "1.1" * 100_000, "+1 (" * 50_000, "1 " * 150_000):
        pii.spans(text)


def test_label_model_finds_reliable_labelers():
    """Votes drawn with known reliabilities: likelihoods tell the truth."""
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.6])
    said = np.where(rng.random((4000, 5)) < right, truth[:, None], ~truth[:, None])
    vote = np.where(rng.random((4000, 5)) < 0.2, 0, np.where(said, 1, -1))
    span = pii.Span("phone", 0, 1, False)
    signature = np.array([pii.signature(span, v) for v in vote.tolist()])
    each, which, counts = np.unique(signature, return_inverse=True, return_counts=True)
    likely = pii.label_model(each, counts.astype(float))[which]
    assert ((likely > 0.5) == truth).mean() > 0.95
    weight = pii.fit_classifier(each, counts.astype(float), pii.label_model(each, counts.astype(float)))
    score = 1 / (1 + np.exp(-pii.features(signature) @ weight))
    assert ((score > 0.5) == truth).mean() > 0.95


def corpus(seed):
    rng = random.Random(seed)
    texts, personal = [], []
    for k in range(400):
        w = [f"w{rng.randrange(999)}" for _ in range(30)]
        # Three documents in four have something personal; others have numbers that only look like it.
        kind = k % 4
        if kind == 0:
            w[10:10] = ["write", "to", f"joe{k}@mail.example.com"]
        elif kind == 1:
            w[10:10] = ["call", "phone", f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"]
        elif kind == 2:
            w[10:10] = ["order", "total", "9" + "".join(rng.choices("123456789", k=15)) + "_x"]
        else:
            w[10:10] = ["phone", f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"]
        personal.append(kind != 2)
        texts.append(" ".join(w))
    return texts, personal


def test_proposals_that_labelers_agree_on_join(spark):
    texts, personal = corpus(1)
    got = {r["row"]["doc_id"]: r["spans"] for r in pii.find_personal(with_clashes(table(spark, texts))).collect()}
    for i, t in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in got[i] if s["base"]]
        assert base == brute(t)
    found = [bool(got[i]) for i in range(len(texts))]
    assert sum(a == b for a, b in zip(found, personal, strict=True)) > 0.95 * len(texts)


def test_masking_and_defined_cases(spark):
    texts = ["mail a@b.com, é +1 714 555 9345 now", "", None, "nothing here"]
    docs = table(spark, texts + texts[:1], [1, 2, 3, 4, 1])
    masked = pii.mask_personal(with_clashes(docs))
    assert masked.columns == with_clashes(docs).columns
    got = sorted((r["doc_id"], r["text"]) for r in masked.collect())
    assert got == [
        (1, "mail [EMAIL], é [PHONE] now"), (1, "mail [EMAIL], é [PHONE] now"), (2, ""), (3, None), (4, "nothing here")
    ]
    assert pii.mask_personal(empty(spark)).count() == 0
    assert as_dict(pii.mask_personal(docs.where("doc_id = 4")))[4]["text"] == "nothing here"
