"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (e-mail, address, card, phone) follow fixed patterns and always stay. Looser patterns propose
more spans. Five labelers vote on every proposal, for, against or not at all: a pattern, a checksum or
number rule, a gazetteer, the words around, and the characters that touch it. Votes are counted over all
documents by pattern of votes, of which there is a fixed number; expectation-maximisation on these counts
estimates how reliable each labeler is and how likely each pattern is personal. A logistic classifier is
then fitted, on the counts of all spans by features, to those likelihoods; it decides which proposals
join the base spans. Texts are scanned in place (twice where they are masked); only counts by pattern are shuffled.

Defined cases: a null or empty text has no spans; spans never overlap within a kind, and a proposal that
overlaps a base span is not made; rows that share a key are judged apart; without proposals nothing is
fitted and nothing added.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.session import pin, short_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "masked_email")
LABELERS = ("pattern", "number", "gazetteer", "context", "edges")
#: A proposal joins at this likelihood.
ACCEPT = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_MASKED = re.compile(
    r"(?<![\w.+-])([A-Za-z0-9][\w.+-]{0,63}) ?(?:\[at\]|\(at\)|\{at\}) ?([A-Za-z0-9-]{1,63}) ?"
    r"(?:\[dot\]|\(dot\)|\{dot\}|\.) ?([A-Za-z]{2,12})(?!\w)",
    re.IGNORECASE,
)

# Gazetteers and cue words of the labelers.
_ENDINGS = frozenset("com org net edu gov io info biz de fr es uk eu us it nl ch at be pl ru jp cn in br ca au".split())
_FOR = {
    "email": frozenset("mail email contact write reach correo courriel address kontakt".split()),
    "masked_email": frozenset("mail email contact write reach correo courriel address kontakt".split()),
    "ip": frozenset("ip host server login address connected from logged".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte tarjeta carte".split()),
    "phone": frozenset("phone tel call mobile cell fax telefon telefono whatsapp dial".split()),
    "ssn": frozenset("ssn social security taxpayer".split()),
}
_AGAINST = frozenset("version release section chapter isbn order invoice total id serial build part page ref".split())
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the e-mail pattern, in linear time from each at-sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def spans(text: str) -> list[Span]:
    """Base spans and proposals of a text, by start and kind."""
    base: list[Span] = []
    more: list[Span] = []
    if "@" in text:
        base += (Span("email", a, b, True) for a, b in _emails(text))
    if _ANY_DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                base.append(Span("ip", m.start(), m.end(), True))
        for m in _DIGITS.finditer(text):
            n = sum("0" <= c <= "9" for c in m.group())
            if 12 <= n <= 19:
                good = _luhn(_only_digits(m.group()))
                (base if good else more).append(Span("card", m.start(), m.end(), good))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_only_digits(m.group())) <= 15:
                base.append(Span("phone", m.start(), m.end(), True))
        more += (Span("phone", m.start(), m.end(), False) for m in _LOCAL_PHONE.finditer(text))
        more += (Span("ssn", m.start(), m.end(), False) for m in _SSN.finditer(text))
    if _ANY_MASK.search(text):
        more += (Span("masked_email", m.start(), m.end(), False) for m in _MASKED.finditer(text))
    if more and base:
        begins = sorted((s.start, s.end) for s in base)
        # Base spans of different kinds may overlap, so the furthest end so far counts.
        starts = np.array([b for b, _ in begins])
        ends = np.maximum.accumulate(np.array([e for _, e in begins]))
        more = [s for s in more if (k := int(np.searchsorted(starts, s.end))) == 0 or ends[k - 1] <= s.start]
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind)))


_ANY_DIGIT = re.compile("[0-9]")
_ANY_MASK = re.compile(r"[\[({]at[\])}]", re.IGNORECASE)


def votes(text: str, span: Span) -> tuple[int, ...]:
    """One vote (1, 0 or -1) of each labeler."""
    cell = text[span.start : span.end]
    digits = _only_digits(cell)
    pattern = 1 if span.base else (1 if span.kind in ("ssn", "masked_email") else 0)
    if span.kind == "card":
        number = 1 if _luhn(digits) else -1
    elif span.kind == "ssn":
        number = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 1
    elif span.kind == "phone":
        number = 1 if len(set(digits)) > 2 else -1
    elif span.kind == "ip":
        number = -1 if cell.startswith(("0.", "127.")) else 1
    else:
        number = 0
    if span.kind in ("email", "masked_email"):
        gazetteer = 1 if re.split(r"[^A-Za-z]+", cell)[-1].lower() in _ENDINGS else -1
    elif span.kind == "card":
        gazetteer = 1 if digits[0] in "3456" else -1
    elif span.kind == "phone":
        gazetteer = 1 if cell.startswith("+") else (-1 if digits[0] in "01" else 0)
    else:
        gazetteer = 0
    near = {w.lower() for w in _WORD.findall(text[max(0, span.start - 60) : span.start])[-6:]}
    context = 1 if near & _FOR[span.kind] else (-1 if near & _AGAINST else 0)
    left = text[span.start - 1] if span.start else " "
    right = text[span.end] if span.end < len(text) else " "
    edges = -1 if left.isalnum() or right.isalnum() or left in "#/_=" or right in "/_=" else 1
    return pattern, number, gazetteer, context, edges


def signature(span: Span, vote: Sequence[int]) -> int:
    """A span's kind and votes as one number, of ``len(KINDS) * 3 ** len(LABELERS)``."""
    out = KINDS.index(span.kind)
    for v in vote:
        out = out * 3 + v + 1
    return out


def _split(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds and votes of signatures."""
    cells, rest = [], signatures.copy()
    for _ in LABELERS:
        cells.append(rest % 3 - 1)
        rest //= 3
    return rest, np.stack(cells[::-1], axis=1)


def label_model(signatures: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """How likely each signature is personal data: EM over the labelers' votes.

    A labeler votes for, against or not at all with probabilities that depend on the truth. It starts out
    right four times in five, and pseudo-counts keep rare votes from being taken as certain.
    """
    _, vote = _split(signatures)
    n_votes = 3
    start = np.array([[0.55, 0.3, 0.15], [0.15, 0.3, 0.55]])  # truth (no, yes) by vote (-1, 0, 1)
    table = np.repeat(start[None], len(LABELERS), axis=0)
    share = 0.5
    onehot = np.stack([vote == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        log = np.einsum("slv,ltv->st", onehot, np.log(table)) + np.log([1 - share, share])
        top = log.max(axis=1, keepdims=True)
        yes = np.exp(log[:, 1] - top[:, 0]) / np.exp(log - top).sum(axis=1)
        weight = np.stack([counts * (1 - yes), counts * yes], axis=1)
        share = (weight[:, 1].sum() + 1) / (counts.sum() + 2)
        table = np.einsum("st,slv->ltv", weight, onehot) + 10 * start[None] * n_votes
        table /= table.sum(axis=2, keepdims=True)
    return yes


def fit_classifier(signatures: np.ndarray, counts: np.ndarray, target: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic weights over kinds and votes, fitted to soft labels by Newton's method with a ridge."""
    x = features(signatures)
    weight = np.zeros(x.shape[1])
    scale = counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weight))
        slope = x.T @ (scale * (p - target)) + 1e-3 * weight
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(weight))
        weight -= np.linalg.solve(curve, slope)
    return weight


def features(signatures: np.ndarray) -> np.ndarray:
    kind, vote = _split(signatures)
    flags = [np.ones(len(kind)), *(kind == k for k in range(len(KINDS)))]
    flags += [vote[:, j] == v for j in range(len(LABELERS)) for v in (-1, 1)]
    return np.stack(flags, axis=1).astype(float)


def accepted_signatures(signatures: np.ndarray, counts: np.ndarray, accept: float = ACCEPT) -> list[int]:
    """Of all signatures, those that the fitted classifier takes as personal."""
    if not len(signatures):
        return []
    weight = fit_classifier(signatures, counts, label_model(signatures, counts))
    every = np.arange(len(KINDS) * 3 ** len(LABELERS))
    likely = 1 / (1 + np.exp(-features(every) @ weight))
    return [int(s) for s in every[likely >= accept]]


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("signature", T.IntegerType()),
    ]
)


_ARROW = ("string", "int32", "int32", "bool", "int32")


def _proposals(docs: DataFrame, text: str, carried: Sequence[str]) -> DataFrame:
    """``row`` (the carried columns) and ``spans`` of every row, as a stored table."""
    short_batches(docs.sparkSession)
    cells = docs.select(F.struct(*carried).alias("row"), F.col(text).alias("text"))

    def find(batches):
        names = _SPAN.names
        kind = pa.list_(pa.struct(list(zip(names, map(pa.type_for_alias, _ARROW), strict=True))))
        for batch in batches:
            found = []
            for cell in batch.column(1):
                t = cell.as_py() or ""
                found.append([dict(zip(names, (*s, signature(s, votes(t, s))), strict=True)) for s in spans(t)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["row", "spans"])

    shape = T.StructType([cells.schema["row"], T.StructField("spans", T.ArrayType(_SPAN))])
    return pin(cells.mapInArrow(find, shape), "proposals")


def find_personal(
    docs: DataFrame, text: str = "text", carried: Sequence[str] = ("doc_id",), accept: float = ACCEPT
) -> DataFrame:
    """``row`` (the carried columns) and the final ``spans`` of every row, by start and kind."""
    found = _proposals(docs, text, carried)
    good = _accepted(found.select(F.explode("spans.signature").alias("signature"), F.lit(1).alias("n")), accept)
    keep = F.array(*map(F.lit, good)) if good else F.array().cast("array<int>")
    return found.withColumn(
        "spans", F.filter("spans", lambda s: s["base"] | F.array_contains(keep, s["signature"]))
    )


def mask_personal(docs: DataFrame, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; all rows and columns stay.

    Texts are read twice, for the votes and to be masked, and stored nowhere.
    """
    short_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def count(batches):
        seen: Counter[int] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(signature(s, votes(t or "", s)) for s in spans(t or ""))
        yield pa.RecordBatch.from_pydict({"signature": pa.array(list(seen), pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "signature int, n long")
    good = frozenset(_accepted(counts, accept))

    def mask(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for r, t in enumerate(texts):
                found = [s for s in spans(t or "") if s[3] or signature(s, votes(t, s)) in good]
                if found:
                    texts[r] = masked(t, [dict(zip(_SPAN.names, s, strict=False)) for s in found])
            columns = batch.columns
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(mask, docs.schema)


def _accepted(counts: DataFrame, accept: float) -> list[int]:
    """Signatures that the classifier accepts, from ``signature, n`` rows."""
    seen = counts.groupBy("signature").agg(F.sum("n")).orderBy("signature").collect()  # at most one row per signature
    return accepted_signatures(np.array([r[0] for r in seen], int), np.array([r[1] for r in seen], float), accept)


def masked(text: str, cells: Sequence[dict]) -> str:
    parts, at = [], 0
    for s in cells:
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = s["end"]
    return "".join(parts) + text[at:]
