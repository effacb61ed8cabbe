"""Stretches of words that repeat with a period, found in every text, and texts with the repeats taken out.

A run is a stretch of consecutive words in which words a smallest period ``q`` apart are equal, of at least
``LEAST`` words and two periods, that no neighbouring word extends. In a run each word occurs twice or
more, so a word met once in a segment lies in no run of it and splits it; the pieces are split again, until
every word of each is met twice. The places of a word's last and next occurrence decide that without
counting, for all segments of all texts of a batch at once.

Segments that survive are scanned by lags, in bands of lags ``Q`` to ``2 * Q - 1``. Equal words at a lag form
a stretch of ``max(LEAST - q, q)`` or more, which holds a whole window of about half that size at one of the
anchors; so windows are compared at anchors only, ``n`` log ``n`` of them in all. What they meet is extended word
by word. A hit inside a known run whose period divides the lag is that run again and is passed over, so a
run is reported under its smallest period only.

Rows are handled where they lie: nothing is shuffled, and no row depends on another. Words are compared by
64-bit hashes.

Defined cases: a null or empty text, or one without words, has no words and no runs, and collapses to an
empty text; a null key stays null; repeated keys and rows are separate rows; a text of any length is scanned
whole, in memory in proportion to its length; overlapping runs of different periods are all reported, and a word is dropped if one
of them drops it; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm import words as W

#: Words of the shortest run.
LEAST = 12
#: Pairs of windows compared at a time.
STEP = 1 << 20

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _neighbours(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The last and the next place of the same word in the same row: -1 or the number of words if there is none."""
    n = len(words.hash)
    order = np.lexsort((words.hash, words.row))
    same = (words.hash[order[1:]] == words.hash[order[:-1]]) & (words.row[order[1:]] == words.row[order[:-1]])
    last, following = np.full(n, -1), np.full(n, n)
    last[order[1:][same]] = order[:-1][same]
    following[order[:-1][same]] = order[1:][same]
    return last, following


def segments(first: np.ndarray, last: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the segments, inside rows that begin at ``first``, whose words all occur twice in them."""
    low, high = first[:-1], first[1:]
    stable: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int))]
    while len(low):
        long = high - low >= LEAST
        low, high = low[long], high[long]
        size = high - low
        part = np.repeat(np.arange(len(low)), size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[part]
        rare = (last[place] < low[part]) & (following[place] >= high[part])
        split = np.bincount(part[rare], minlength=len(low)) > 0
        stable.append((low[~split], high[~split]))
        left = ~rare & split[part]
        place, part = place[left], part[left]
        if not len(place):
            break
        begin = np.flatnonzero(np.concatenate(([True], (np.diff(place) != 1) | (np.diff(part) != 0))))
        low, high = place[begin], place[np.append(begin[1:], len(place)) - 1] + 1
    return np.concatenate([a for a, _ in stable]), np.concatenate([b for _, b in stable])


def _shortest(lags: np.ndarray) -> int:
    """The fewest equal words in a row, at one of the lags, that a run has."""
    return int(np.maximum(LEAST - lags, lags).min())


def _hits(values: np.ndarray, lags: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and lags at which windows of ``size`` values are equal, by lag and anchor."""
    hashes = W.windows(values, size)
    anchors = np.arange(0, len(hashes) - lags[0], step)
    found = []
    many = max(1, STEP // len(lags))
    for at in range(0, len(anchors), many):
        x = anchors[at : at + many]
        y = x[:, None] + lags[None, :]
        equal = hashes[np.minimum(y, len(hashes) - 1)] == hashes[x][:, None]
        a, b = np.nonzero(equal & (y < len(hashes)))
        found.append((x[a], lags[b]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    x, q = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((x, q))
    return x[order], q[order]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many values agree from the beginning on."""
    n, at, size = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(n, at + size)] != b[at : min(n, at + size)])
        if len(differ):
            return at + int(differ[0])
        at, size = at + size, 4 * size
    return n


def lag_scan(values: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs of a segment, by start and period."""
    n, runs = len(values), []
    band = 1
    while band <= n // 2:
        lags = np.arange(band, min(2 * band, n // 2 + 1))
        least = _shortest(lags)
        size = max(1, least // 2)
        x, q = _hits(values, lags, size, least - size + 1)
        new = np.ones(len(x), bool)
        if len(x) and runs:
            # Runs of smaller periods come from earlier bands: a period that divides a lag is half of it at most.
            by_place = np.argsort(x, kind="stable")
            places = x[by_place]
            for start, length, period in runs:
                inside = by_place[np.searchsorted(places, start) : np.searchsorted(places, start + length)]
                inside = inside[(q[inside] % period == 0) & (x[inside] + q[inside] + size <= start + length)]
                new[inside] = False
        x, q = x[new], q[new]
        at = 0
        while at < len(x):
            place, lag = int(x[at]), int(q[at])
            back = _agree(values[:place][::-1], values[lag : place + lag][::-1])
            length = back + _agree(values[place:], values[place + lag :]) + lag
            if length >= max(LEAST, 2 * lag):
                runs.append((place - back, length, lag))
            # The next hit beyond this stretch.
            end = int(np.searchsorted(q, lag, "right"))
            at += max(1, int(np.searchsorted(x[at:end], place - back + length - lag)))
        band *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, listed, texts = [], [], []
        for chunk in W.chunks(batch.column(1)):
            words = W.find_words(chunk)
            first, data = words.first, chunk.data.tobytes()
            runs: dict[int, list[tuple[int, int, int]]] = {}
            for low, high in zip(*segments(first, *_neighbours(words)), strict=True):
                found = lag_scan(words.hash[low:high])
                if found:
                    row = int(words.row[low])
                    begin = int(low - first[row])
                    runs.setdefault(row, []).extend((begin + s, n, p) for s, n, p in found)
            for row in range(chunk.high - chunk.low):
                a, b = int(first[row]), int(first[row + 1])
                counts.append(b - a)
                own = sorted(runs.get(row, ()), key=lambda r: (r[0], r[2]))
                listed.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                begins, ends = words.start[a:b], words.end[a:b]
                if own:
                    edge = np.zeros(b - a + 1, np.int64)
                    for s, n, p in own:
                        edge[s + p] += 1
                        edge[s + n] -= 1
                    kept = np.cumsum(edge[:-1]) == 0
                    begins, ends = begins[kept], ends[kept]
                texts.append(b" ".join([data[s:e] for s, e in zip(begins.tolist(), ends.tolist(), strict=True)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(listed, RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
            ["key", "n_words", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, runs, collapsed`` of every row.

    ``runs`` are ``start, length, period`` in words, by start and period; ``collapsed`` are the words outside
    of all repeats, that is of a run only its first period, joined by one space.
    """
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    cells = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shape = f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    found = cells.mapInArrow(_collapse, shape)
    return found.withColumnRenamed("key", key)


def longest_run(runs: str = "runs") -> F.Column:
    """The run of the greatest length; of equal ones that of the smallest start, then period; null without runs."""
    order = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(order)
    return F.struct(best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period"))
