"""Substring dedup: difference-cover anchors find passages that occur in an earlier document.

A passage is a window of 13 words. Of every text only the 7-word windows at places 0, 1 and 3 modulo 7 are
hashed: these residues cover all differences modulo 7, so two equal 13-word windows, wherever they begin,
share an anchor at the same offset of at most 6, which lies whole within them. Anchors that two documents
share are extended: the 13-word windows around them, and only these, are hashed and compared. Hashes move
packed (see ``exchange``); a text is read again only where something was found in it.

Defined cases: a null or empty text has no words; a null id is smaller than all others; rows of the same
id are the same document, so they remove nothing from each other, but each is judged; a passage repeated
within one document stays. Equal windows are recognised by 64-bit hashes, twice, of anchor and window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm import exchange as X
from prepkit.llm import words as W
from prepkit.session import pin, small_side

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1


def _anchors(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a chunk; residues count from the begin of each row."""
    place, hashes = W.row_windows(found, ANCHOR)
    rest = (place - found.first[found.row[place]]) % PERIOD
    chosen = np.isin(rest, COVER)
    return place[chosen], hashes[chosen]


def _keys(batch: pa.RecordBatch, chunk: W.Chunk) -> np.ndarray:
    return batch.column(0).slice(chunk.low, chunk.high - chunk.low).to_numpy(zero_copy_only=False)


def _anchor_entries(batch):
    for chunk in W.chunks(batch.column(1)):
        found = W.find_words(chunk)
        place, hashes = _anchors(found)
        yield hashes, _keys(batch, chunk)[found.row[place]]


def _window_entries(batch):
    """Windows that hold a shared anchor at the offset of a common begin."""
    for chunk in W.chunks(batch.column(1)):
        found = W.find_words(chunk)
        keys, cells = _keys(batch, chunk), batch.column(2).slice(chunk.low, chunk.high - chunk.low)
        place, hashes = _anchors(found)
        wide, wide_hash = W.row_windows(found, WINDOW)
        begins = np.zeros(len(found.start) + 1, bool)
        cut = np.searchsorted(found.row[place], np.arange(len(keys) + 1))
        for r, held in enumerate(cells.to_pylist()):
            own = slice(cut[r], cut[r + 1])
            shared = place[own][X.is_in(hashes[own], X.unpacked(held))]
            for back in range(PERIOD):
                begins[np.maximum(shared - back, found.first[r])] = True
        chosen = begins[wide]
        yield wide_hash[chosen], keys[found.row[wide[chosen]]]


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, hashes``: 13-word windows of a document that also begin in one of a smaller id (a stored table)."""
    cells = docs.select(X.safe_key(key).alias("key"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = X.range_count(docs, size * len(COVER) // (6 * PERIOD))
    anchors = pin(X.shared_hashes(cells, _anchor_entries, ranges), "anchors")
    some = cells.join(small_side(anchors.select("key")), "key", "left_semi").join(anchors, "key")
    return pin(X.shared_hashes(some.select("key", "text", "hashes"), _window_entries, ranges, later=True), "windows")


def _kept(held_column: int | None, texts: bool):
    """An Arrow function: counts, digest and (with ``texts``) text of the kept words of each row."""

    def cut(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column(1)):
                found = W.find_words(chunk)
                n = chunk.high - chunk.low
                removed = np.zeros(len(found.start), bool)
                if held_column is not None:
                    wide, hashes = W.row_windows(found, WINDOW)
                    cut_at = np.searchsorted(found.row[wide], np.arange(n + 1))
                    begins = []
                    for r, held in enumerate(batch.column(held_column).slice(chunk.low, n).to_pylist()):
                        own = slice(cut_at[r], cut_at[r + 1])
                        begins.append(wide[own][X.is_in(hashes[own], X.unpacked(held))])
                    removed = W.covered(np.concatenate(begins), WINDOW, len(removed))
                gone = np.concatenate(([0], np.cumsum(removed)))[found.first]
                kept = [
                    " ".join(_words(chunk, found, removed, r))
                    if gone[r + 1] > gone[r] or texts
                    else _plain(chunk, r)
                    for r in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.low, n),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(np.diff(gone), pa.int64()),
                        pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept], pa.string()),
                        pa.array(kept if texts else [None] * n, pa.string()),
                    ],
                    ["key", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return cut


def _plain(chunk: W.Chunk, row: int) -> str:
    """All words of a row, one space between them."""
    raw = chunk.data[chunk.offsets[row] : chunk.offsets[row + 1]].tobytes()
    return b" ".join(raw.split()).decode("utf-8")


def _words(chunk: W.Chunk, found: W.Words, removed: np.ndarray, row: int):
    for i in range(found.first[row], found.first[row + 1]):
        if not removed[i]:
            yield chunk.text(found.start[i], found.end[i])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of every row, and with ``texts`` the kept words as ``kept_text``.

    A word goes if a 13-word window over it also begins in a document of a smaller id.
    """
    held = repeated_windows(docs, key, text)
    cells = docs.select(X.safe_key(key).alias("key"), F.col(text).alias("text"))
    ids = small_side(held.select("key"))
    shape = "key long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    clean = cells.join(ids, "key", "left_anti").mapInArrow(_kept(None, texts), shape)
    some = cells.join(ids, "key", "left_semi").join(held, "key")
    cut = some.select("key", "text", "hashes").mapInArrow(_kept(2, texts), shape)
    out = clean.unionByName(cut).withColumn("key", F.nullif("key", F.lit(X.NULL_KEY)))
    return out.select(F.col("key").alias(key), "n_words", "n_removed", "kept_sha256", *(["kept_text"] if texts else []))
