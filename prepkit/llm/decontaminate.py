"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over all documents.

The windows of the test items are hashed and held in memory; their number is counted first, and an item
set with more than ``max_windows`` is cut into blocks, of which a task holds one at a time, so that what a
task holds never exceeds that bound. Every document is read whole by the task that holds it. A hash that
occurs is verified word by word before it counts. Documents are not shuffled.

Defined cases: a null text has no words; an item without words has no window; an item shorter than the
window is one window of its own length; items of the same id are one item; a null item id reads ``null``;
repeated documents are reported once per row; an empty item table leaves everything clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import words as W
from prepkit.session import short_batches

WINDOW = 10
#: Windows held by a task at a time: at most about 200 bytes each.
MAX_WINDOWS = 500_000

_PREFIX_BITS = 20


class WindowSet:
    """Windows of a block of items: sorted hashes by length, their words, and the items of each."""

    def __init__(self, rows: list[tuple[str, int, int, bytes]]):
        self.items: list[str] = sorted({r[0] for r in rows})
        number = {item: k for k, item in enumerate(self.items)}
        found: dict[tuple[int, int], dict[bytes, set[int]]] = {}
        for item, size, key, text in rows:
            found.setdefault((size, key), {}).setdefault(text, set()).add(number[item])
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list[dict[bytes, set[int]]]]] = {}
        for size in sorted({s for s, _ in found}):
            keys = sorted(k for s, k in found if s == size)
            hashes = np.array(keys, np.int64).view(np.uint64)
            order = np.argsort(hashes)
            seen = np.zeros(1 << _PREFIX_BITS, bool)
            seen[hashes >> np.uint64(64 - _PREFIX_BITS)] = True
            self.by_size[size] = (hashes[order], seen, [found[size, keys[k]] for k in order])

    def hits(self, chunk: W.Chunk, found: W.Words) -> Iterator[tuple[int, int, set[int]]]:
        """First word, size and items of each verified window of the chunk."""
        for size, (hashes, seen, texts) in self.by_size.items():
            place, got = W.row_windows(found, size)
            some = np.flatnonzero(seen[got >> np.uint64(64 - _PREFIX_BITS)])
            at = np.searchsorted(hashes, got[some])
            at[at == len(hashes)] = 0
            some, at = some[hashes[at] == got[some]], at[hashes[at] == got[some]]
            for first, k in zip(place[some].tolist(), at.tolist(), strict=True):
                items = texts[k].get(_window_text(chunk, found, first, size))
                if items:
                    yield first, size, items


def _window_text(chunk: W.Chunk, found: W.Words, first: int, size: int) -> bytes:
    """The folded words of a window, one space between them."""
    cut = [chunk.data[found.start[i] : found.end[i]] for i in range(first, first + size)]
    return b" ".join(W.LOWER[x].tobytes() for x in cut)


def item_windows(items: DataFrame, item_key: str, text: str, size: int = WINDOW) -> DataFrame:
    """``item, size, hash, words`` of every distinct window of the items."""

    def cut(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column(1)):
                found = W.find_words(chunk, W.LETTERS, W.LOWER)
                n = np.diff(found.first)
                place, hashes = W.row_windows(found, size)
                out = [(int(found.row[i]), size, h, int(i)) for i, h in zip(place, hashes, strict=True)]
                short = np.flatnonzero((n > 0) & (n < size))
                whole = W.whole_rows(found, short)
                out += [(int(r), int(n[r]), h, int(found.first[r])) for r, h in zip(short, whole, strict=True)]
                names = batch.column(0).slice(chunk.low, chunk.high - chunk.low).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[r] for r, _, _, _ in out], pa.string()),
                        pa.array([s for _, s, _, _ in out], pa.int32()),
                        pa.array(np.array([h for _, _, h, _ in out], np.uint64).view(np.int64)),
                        pa.array([_window_text(chunk, found, i, s) for _, s, _, i in out], pa.binary()),
                    ],
                    ["item", "size", "hash", "words"],
                )

    cells = items.select(
        F.coalesce(F.col(item_key).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text")
    )
    return cells.mapInArrow(cut, "item string, size int, hash long, words binary").distinct()


def window_blocks(spark: SparkSession, found: DataFrame, max_windows: int = MAX_WINDOWS) -> list[Broadcast]:
    """Broadcast window sets that together hold all windows, each at most about ``max_windows``."""
    blocks = -(-found.count() // max_windows)
    out = []
    for k in range(blocks):
        part = found if blocks == 1 else found.where(F.pmod(F.xxhash64("hash", "words"), F.lit(blocks)) == k)
        out.append(spark.sparkContext.broadcast(WindowSet([tuple(r) for r in part.toLocalIterator()])))
    return out


def _each(blocks: list[Broadcast]) -> Iterator[WindowSet]:
    """The sets one after another; of several, a task holds one at a time."""
    if len(blocks) == 1:
        yield blocks[0].value
    else:
        for held in blocks:
            yield held.load_from_path(held._path)


def _batch_hits(
    blocks: list[Broadcast], column: pa.Array
) -> Iterator[tuple[W.Chunk, W.Words, np.ndarray, dict[int, set[str]]]]:
    """Each chunk of a column with its words, which of them are hit, and the items of its rows."""
    cut = list(W.chunks(column))
    hit: list[np.ndarray | None] = [None] * len(cut)
    items: list[dict[int, set[str]]] = [{} for _ in cut]
    for windows in _each(blocks):
        for k, chunk in enumerate(cut):
            found = W.find_words(chunk, W.LETTERS, W.LOWER)
            by_size: dict[int, list[int]] = {}
            for first, size, which in windows.hits(chunk, found):
                by_size.setdefault(size, []).append(first)
                items[k].setdefault(int(found.row[first]), set()).update(windows.items[i] for i in which)
            for size, firsts in by_size.items():
                flags = W.covered(np.array(firsts), size, len(found.start))
                hit[k] = flags if hit[k] is None else hit[k] | flags
    for k, chunk in enumerate(cut):
        found = W.find_words(chunk, W.LETTERS, W.LOWER)
        yield chunk, found, np.zeros(len(found.start), bool) if hit[k] is None else hit[k], items[k]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``key, n_words, n_hit, items, run_start, run_end`` of each row: hit words as runs of word places."""
    short_batches(docs.sparkSession)
    blocks = window_blocks(docs.sparkSession, item_windows(items, item_key, item_text, size), max_windows)

    def find(batches):
        for batch in batches:
            for chunk, found, hit, which in _batch_hits(blocks, batch.column(1)):
                n = chunk.high - chunk.low
                begins, ends, names, n_hit = [[]] * n, [[]] * n, [[]] * n, [0] * n
                for r, found_items in which.items():
                    a, b = W.runs(hit[found.first[r] : found.first[r + 1]])
                    begins[r], ends[r], n_hit[r] = a.tolist(), b.tolist(), int((b - a).sum())
                    names[r] = sorted(found_items)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.low, n),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array(names, pa.list_(pa.string())),
                        pa.array(begins, pa.list_(pa.int64())),
                        pa.array(ends, pa.list_(pa.int64())),
                    ],
                    ["key", "n_words", "n_hit", "items", "run_start", "run_end"],
                )

    cells = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = cells.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_words long, n_hit long, items array<string>, run_start array<long>, run_end array<long>"
    return cells.mapInArrow(find, shape).withColumnRenamed("key", key)


def remove_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` without the hit words: all rows and columns stay, a removed run leaves one space."""
    short_batches(docs.sparkSession)
    blocks = window_blocks(docs.sparkSession, item_windows(items, item_key, item_text, size), max_windows)
    place = docs.columns.index(text)

    def cut(batches):
        for batch in batches:
            for chunk, found, hit, which in _batch_hits(blocks, batch.column(place)):
                rows = batch.slice(chunk.low, chunk.high - chunk.low)
                if not which:
                    yield rows
                    continue
                texts = rows.column(place).to_pylist()
                for r in which:
                    texts[r] = _without(chunk, found, hit, r)
                columns = list(rows.columns)
                columns[place] = pa.array(texts, batch.schema.types[place])
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(cut, docs.schema)


def _without(chunk: W.Chunk, found: W.Words, hit: np.ndarray, row: int) -> str:
    low, high = found.first[row], found.first[row + 1]
    begins, ends = W.runs(hit[low:high])
    parts, at = [], chunk.offsets[row]
    for a, b in zip(begins + low, ends + low, strict=True):
        parts.append(chunk.text(at, found.start[a]).rstrip(" "))
        at = found.end[b - 1]
    parts.append(chunk.text(at, chunk.offsets[row + 1]).lstrip(" "))
    return " ".join(p for p in parts if p)
