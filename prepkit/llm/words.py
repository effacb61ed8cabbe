"""Words and word windows of Arrow text columns, as NumPy arrays.

Texts are handled as UTF-8 bytes: all separators are ASCII, so cutting bytes cuts characters. A word's
hash is 64 bits of its (folded) bytes; a window's hash is 64 bits of its words' hashes. Equal words have
equal hashes everywhere; two given unequal ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time, of which the arrays of a task take some eighty times as many, and hashed at a time.
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 1 << 18

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_RANDOM = np.random.default_rng(20240601)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A flag per byte value, true outside the (inclusive) ranges."""
    flags = np.ones(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = False
    return flags


#: Words between ASCII white space.
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of ASCII digits and letters and all other characters beyond ASCII.
LETTERS = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: As they come, and with A-Z in lower case.
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.size = base, pow(base, -1, 2**64), 0

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > max(self.size, BLOCK_BYTES):
            return _powers(self.base, n), _powers(self.inverse, n)
        if not self.size:
            self.size = BLOCK_BYTES
            self.up, self.down = _powers(self.base, self.size), _powers(self.inverse, self.size)
        return self.up, self.down

    def __getstate__(self):
        return {"base": self.base, "inverse": self.inverse, "size": 0}


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


class Chunk(NamedTuple):
    """Rows ``low`` to ``high`` of a batch: their bytes, and where each row begins in them."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8")


class Words(NamedTuple):
    """Byte bounds of the words, the row of each, the first word of each row, and their hashes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into runs of whole rows of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield Chunk(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def find_words(
    chunk: Chunk, is_word: np.ndarray = NOT_SPACE, fold: np.ndarray = AS_IS, hashed: bool = True
) -> Words:
    """The words of each row of ``chunk``; no word spans two rows."""
    data, offsets = chunk.data, chunk.offsets
    inside = is_word[fold][data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        begins[cuts] = inside[cuts]
        cuts = offsets[1:][offsets[1:] > 0] - 1
        ends[cuts] = inside[cuts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, first, hash_spans(data, start, end, fold) if hashed else np.zeros(0, _U))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray = AS_IS) -> np.ndarray:
    """Hashes of spans of (folded) bytes that are not empty, in order, and do not overlap."""
    values = _BYTE_VALUES[fold]
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        low = start[i]
        j = max(i + 1, int(np.searchsorted(end, low + BLOCK_BYTES, "right")))
        high = end[j - 1]
        up, down = _BYTES(int(high - low))
        total = np.zeros(high - low + 1, _U)
        np.cumsum(values[data[low:high]] * up[: high - low], out=total[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(_U) * _U(0xA24BAED4963EE407))
        i = j
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` values from each place on; ``len - size + 1`` results, rows not regarded."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, _U)
    up, down = _WORDS(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix((total[size:] - total[: n - size + 1]) * down[: n - size + 1] + _U(size))


def row_windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the windows that lie within one row."""
    hashes = windows(words.hash, size)
    place = np.flatnonzero(words.row[: len(hashes)] == words.row[size - 1 :]) if len(hashes) else np.zeros(0, int)
    return place, hashes[place]


def whole_rows(words: Words, rows: np.ndarray) -> np.ndarray:
    """One hash of all words of each of the rows, for rows of a few words."""
    out = np.zeros(len(rows), _U)
    n = words.first[rows + 1] - words.first[rows]
    for size in np.unique(n[n > 0]):
        which = n == size
        out[which] = windows(words.hash, int(size))[words.first[rows[which]]]
    return out


def covered(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words that begins at one of ``first``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size, -1)
    return np.cumsum(edge[:n]) > 0


def char_places(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points before each of the byte places."""
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=count[1:])
    return count[places]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and (exclusive) ends of the runs of true flags."""
    padded = np.zeros(len(flags) + 2, np.int8)
    padded[1:-1] = flags
    step = np.diff(padded)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
