"""Which hashes occur under more than one key? An exchange of packed hashes.

Every key (a document) brings 64-bit hashes. Tasks pack theirs into one binary cell per hash range, so
that the shuffle moves arrays instead of rows, and keep one entry per hash and run of input: its smallest
key. A hash that a third of all rows hold thus reaches the task of its range once per run of input, and
what a run of input shows by itself is not asked again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.words import mix

#: Hashes packed at a time by a task, and hashes that a range should hold.
RUN, RANGE = 1 << 20, 1 << 21
#: Stands for a null key, which so is the smallest.
NULL_KEY = -(2**63)

Entries = Iterator[tuple[np.ndarray, np.ndarray]]


def range_count(df: DataFrame, expected: int) -> int:
    """A power of two: ranges of at most about ``RANGE`` hashes, and enough of them for all tasks."""
    wanted = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-expected // RANGE))
    return 1 << max(1, int(wanted - 1).bit_length())


def packed(hashes: np.ndarray) -> bytes:
    """Bytes of 64-bit values, those of the same weight side by side, which compresses better."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(cell: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(cell, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _groups(hashes: np.ndarray, keys: np.ndarray):
    order = np.argsort(hashes)
    hashes, keys = hashes[order], keys[order]
    begin = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    size = np.diff(np.append(begin, len(hashes)))
    least, most = np.minimum.reduceat(keys, begin), np.maximum.reduceat(keys, begin)
    return hashes, keys, begin, size, least, most


def _found(hashes, keys, size, least, most, later: bool) -> np.ndarray:
    """Of sorted entries, those whose hash has another key (``later``: a smaller one)."""
    return keys > np.repeat(least, size) if later else np.repeat(least < most, size)


def _cells(hashes: np.ndarray, keys: np.ndarray, cut: np.ndarray, ranges) -> pa.RecordBatch:
    bounds = zip(cut[:-1], cut[1:], strict=True)
    cells = [(packed(hashes[a:b]), packed(keys[a:b].view(np.uint64))) for a, b in bounds]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ranges, pa.int64()),
            pa.array([c[0] for c in cells], pa.large_binary()).cast(pa.binary()),
            pa.array([c[1] for c in cells], pa.large_binary()).cast(pa.binary()),
        ],
        ["range", "hashes", "keys"],
    )


def shared_hashes(
    df: DataFrame, entries: Callable[[pa.RecordBatch], Entries], ranges: int, later: bool = False
) -> DataFrame:
    """``key, hashes``: for a key, packed hashes of its own that also occur under another (smaller) key.

    ``entries`` turns an Arrow batch of ``df`` into arrays of hashes and their 64-bit keys. What the ranges
    find is packed again, by ranges of mixed keys, so that each key gets one row with its distinct hashes.
    """
    bits = np.uint64(64 - (ranges.bit_length() - 1))

    def pack(batches):
        task, runs = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            hashes, keys, begin, size, least, most = _groups(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            own = _found(hashes, keys, size, least, most, later)
            if own.any():
                # Known without asking: passed on under a range of its own, below zero.
                place = -(1 + task * 1024 + runs % 1024)
                yield _cells(hashes[own], keys[own], np.array([0, own.sum()]), [place])
            hashes = hashes[begin]
            which = (hashes >> bits).astype(np.int64)
            cut = _cuts(which)
            yield _cells(hashes, least, cut, which[cut[:-1]])

        for batch in batches:
            for hashes, keys in entries(batch):
                if len(hashes):
                    held.append((hashes, keys))
                if sum(len(h) for h, _ in held) >= RUN:
                    yield from flush()
                    runs += 1
        if held:
            yield from flush()

    def answer(key, table):
        hashes, keys = _joined(table)
        if key[0].as_py() >= 0:
            hashes, keys, _, size, least, most = _groups(hashes, keys)
            which = _found(hashes, keys, size, least, most, later)
            hashes, keys = hashes[which], keys[which]
        place = (mix(keys.view(np.uint64)) >> bits).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place = place[order]
        cut = _cuts(place)
        return pa.Table.from_batches([_cells(hashes[order], keys[order], cut, place[cut[:-1]])])

    def gather(key, table):
        hashes, keys = _joined(table)
        order = np.lexsort((hashes, keys))
        hashes, keys = hashes[order], keys[order]
        fresh = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])))
        hashes, keys = hashes[fresh], keys[fresh]
        cut = _cuts(keys)
        cells = [packed(hashes[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"key": pa.array(keys[cut[:-1]], pa.int64()), "hashes": pa.array(cells, pa.binary())})

    shape = "range long, hashes binary, keys binary"
    found = df.mapInArrow(pack, shape).groupBy("range").applyInArrow(answer, shape)
    return found.groupBy("range").applyInArrow(gather, "key long, hashes binary")


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate([unpacked(c) for c in table.column("hashes").to_pylist()])
    return hashes, np.concatenate([unpacked(c).view(np.int64) for c in table.column("keys").to_pylist()])


def _cuts(values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    return np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1, [len(values)])) if len(values) else np.zeros(1, int)


def is_in(hashes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which hashes are among the sorted ``held``."""
    if not len(held):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(held, hashes)
    at[at == len(held)] = 0
    return held[at] == hashes


def safe_key(name: str) -> F.Column:
    """An integer key, a null as the smallest one."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_KEY))
