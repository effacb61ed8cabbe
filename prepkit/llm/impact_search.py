"""Exact nearest vectors by integer inner product, over an impact-ordered index, score at a time.

Components become integers. Vectors are indexed in blocks: for each dimension the rows of a block are
ordered by value and cut into segments of one quantised value each. For a query a segment has an impact: the
most that its value can add beyond the worst value of its dimension, so no impact is negative, whatever
the signs. Segments are processed in falling order of impact over all dimensions, each adding its impact to
the sums of its rows.

At any time a row can reach its sum and what the next segment of each dimension may still add, and it has
at least its sum less the widths of the segments. A row whose upper bound is below the ``k`` best lower bounds, or below
the ``k`` exact scores known to the task, is proved to be outside. Processing stops as soon as all but a small
part of the rows are outside, or at the end of the index; all rows that are not are scored exactly.

The index is stored once; a row's number in it tells a query from its equals. Queries come in blocks of
bounded size, each of which is broadcast and meets every block of the index. Tasks keep the best ``k`` of a
query, so equal vectors gather nowhere.

Defined cases: a vector that is null, or holds a null, or a component that is not finite (or not once
scaled) takes no part, neither as a query nor as a candidate; an empty vector has a product of 0 with all; of vectors of
different lengths the missing components count as 0; rows with an id of their own query are candidates, but
for the row of the query; queries that share an id are answered separately; a null id is no query and the
smallest candidate; equal scores are ranked by id; numbers too large for sums of 52 bits are summed by
Python's integers, and a score beyond 64 bits is given as the nearest long; empty tables give no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepkit.llm import exchange as X
from prepkit.session import pin

#: Rows of a block, quantised values of a dimension, and parts in which the segments are processed.
ROWS, LEVELS, PARTS = 8192, 32, 16
#: Processing stops when so many rows, or this share of a block, may still be members.
FEW, SHARE = 32, 32
#: Bytes of queries handled at a time.
QUERY_BYTES = 16 << 20
#: Sums up to this are exact in floating point.
EXACT = 1 << 52
NONE = np.iinfo(np.int64).min

INDEX = "number long, width int, keys binary, asked binary, `values` binary, rows binary, edges binary"


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components of all vectors one after the other, where each begins, and which vectors take part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = ~column.is_null().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = np.concatenate(([0], np.cumsum(sizes)))
    return values, first, whole


def segments_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by value for each dimension, and ``first row, least value, greatest value`` of each segment."""
    n, width = values.shape
    rows = np.argsort(values, axis=0, kind="stable").T.astype(np.uint16)
    low, high = values.min(axis=0), values.max(axis=0)
    step = np.maximum(1, np.ceil((high - low + 1) / LEVELS))
    edges = np.zeros((width, LEVELS + 1, 3))
    for d in range(width):
        ordered = values[rows[d], d]
        ends = low[d] + step[d] * np.arange(LEVELS + 1)
        edges[d, :, 0] = np.searchsorted(ordered, ends)
        edges[d, :, 1] = np.minimum(ends, high[d])
        edges[d, :, 2] = np.minimum(ends + step[d] - 1, high[d])
        edges[d, -1, 0] = n
    return rows, edges


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    held: dict[int, list[tuple]] = {}

    def flush(width: int) -> pa.RecordBatch:
        nonlocal number
        keys, asked, vectors = zip(*held.pop(width), strict=True)
        values = np.stack(vectors)
        rows, edges = segments_of(values)
        cells = [np.array(keys, np.int64), np.array(asked, bool), values, rows, edges]
        first, number = number, number + len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), pa.array([width], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
            ["number", "width", "keys", "asked", "values", "rows", "edges"],
        )

    for batch in batches:
        values, first, whole = _vectors(batch.column(2))
        with np.errstate(over="ignore", invalid="ignore"):
            values = np.floor(256.0 * values)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        whole &= bad[first[1:]] == bad[first[:-1]]
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        asked = batch.column(1).to_numpy(zero_copy_only=False)
        for r in np.flatnonzero(whole):
            width = int(first[r + 1] - first[r])
            held.setdefault(width, []).append((keys[r], asked[r], values[first[r] : first[r + 1]].copy()))
            if len(held[width]) == ROWS:
                yield flush(width)
    for width in sorted(held):
        yield flush(width)


class Block:
    """A block of the index."""

    def __init__(self, number: int, width: int, keys: bytes, asked: bytes, values: bytes, rows: bytes, edges: bytes):
        self.number, self.width = number, width
        self.keys, self.asked = np.frombuffer(keys, np.int64), np.frombuffer(asked, bool)
        n = len(self.keys)
        self.values = np.frombuffer(values).reshape(n, width)
        self.rows = np.frombuffer(rows, np.uint16).reshape(width, n)
        self.edges = np.frombuffer(edges).reshape(width, LEVELS + 1, 3)
        self.most = float(np.abs(self.values).max(initial=0))

    def search(self, query: np.ndarray, number: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the ``k`` best and reach ``floor``, with their exact scores."""
        width = min(len(query), self.width)
        q = query[:width]
        own = number - self.number if self.number <= number < self.number + len(self.keys) else -1
        if width * self.most * np.abs(q).max(initial=0) < EXACT:
            rows = self._possible(q, own, k, floor)
            return rows, (self.values[rows, :width] @ q).astype(np.int64)
        rows = np.delete(np.arange(len(self.keys)), [own] if own >= 0 else [])
        whole = [[int(v) for v in self.values[r, :width]] for r in rows]
        scores = [sum(x * int(y) for x, y in zip(v, q, strict=True)) for v in whole]
        return rows, np.array([min(max(s, NONE + 1), -NONE - 1) for s in scores], np.int64)

    def _possible(self, q: np.ndarray, own: int, k: int, floor: int) -> np.ndarray:
        n = len(self.keys)
        used = np.flatnonzero(q)
        sign = q[used] > 0
        edges, size = self.edges[used], np.abs(q[used])
        low, high = edges[:, 0, 1], edges[:, -1, 2]
        base = float((q[used] * np.where(sign, low, high)).sum())
        # Impacts by dimension and level; the order of levels is reversed where the query is positive.
        best = np.where(sign[:, None], edges[:, :-1, 2] - low[:, None], high[:, None] - edges[:, :-1, 1])
        impact = size[:, None] * np.maximum(best, 0)
        wide = size * (edges[:, 0, 2] - edges[:, 0, 1])  # no segment is wider than the first
        dims, levels = np.nonzero(np.diff(edges[:, :, 0], axis=1) > 0)
        order = np.argsort(-impact[dims, levels], kind="stable")
        dims, levels = dims[order], levels[order]
        rest = impact.copy()
        rest[np.diff(edges[:, :, 0], axis=1) == 0] = 0
        total = np.zeros(n)
        seen = np.zeros(len(used), bool)
        few = max(FEW, n // SHARE)
        for part in np.array_split(np.arange(len(dims)), PARTS):
            if len(part):
                d, level = dims[part], levels[part]
                a, b = edges[d, level, 0].astype(int), edges[d, level + 1, 0].astype(int)
                rows = np.concatenate([self.rows[used[x], s:e] for x, s, e in zip(d, a, b, strict=True)])
                total += np.bincount(rows, np.repeat(impact[d, level], b - a), n)
                rest[d, level] = 0
                seen[d] = True
            least = total - wide[seen].sum()
            if own >= 0:
                least[own] = -np.inf
            bar = float(floor) - base
            if n - (own >= 0) >= k:
                bar = max(bar, np.partition(least, n - k)[n - k])
            possible = total + rest.max(axis=1, initial=0).sum() >= bar
            if own >= 0:
                possible[own] = False
            if possible.sum() <= few:
                break
        return np.flatnonzero(possible)


def index(vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The stored index of all vectors that take part; ``asked`` tells which rows are queries."""
    cells = vectors.select(X.safe_key(key).alias("key"), F.coalesce(asked, F.lit(False)).alias("asked"), F.col(vector).alias("vector"))
    return pin(cells.mapInArrow(_build, INDEX), "impacts")


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(**row)
            own = np.flatnonzero(block.asked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.number + own, pa.int64()), pa.array(block.keys[own], pa.int64()),
                 pa.array([block.values[r].tobytes() for r in own], pa.binary())],
                ["number", "key", "query"],
            )


def query_blocks(stored: DataFrame, limit: int = QUERY_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """``number, id, components`` of the queries, in blocks of about ``limit`` bytes."""
    block, size = [], 0
    for row in stored.mapInArrow(_queries, "number long, key long, query binary").toLocalIterator():
        block.append((row["number"], row["key"], bytes(row["query"])))
        size += len(row["query"]) + 64
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def _answers(spark: SparkSession, stored: DataFrame, block: list[tuple[int, int, bytes]], k: int) -> DataFrame:
    """``number, query_id, value, key``: of each task the ``k`` best of each query of a block."""
    held = spark.sparkContext.broadcast(block)

    def answer(batches):
        queries = [(number, np.frombuffer(cell)) for number, _, cell in held.value]
        scores = np.full((len(queries), k), NONE)
        keys = np.zeros((len(queries), k), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                part = Block(**row)
                for i, (number, query) in enumerate(queries):
                    rows, found = part.search(query, number, k, scores[i, -1])
                    found = np.concatenate((scores[i], found))
                    names = np.concatenate((keys[i], part.keys[rows]))
                    best = np.lexsort((names, ~found))[:k]  # ~x falls as x rises, for the least number too
                    scores[i], keys[i] = found[best], names[best]
        i, j = np.nonzero(scores != NONE)
        numbers = np.array([q[0] for q in held.value], np.int64)
        names = np.array([q[1] for q in held.value], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (numbers[i], names[i], scores[i, j], keys[i, j])], ["number", "query_id", "value", "key"]
        )

    return stored.mapInArrow(answer, "number long, query_id long, value long, key long")


def nearest(
    vectors: DataFrame, asked: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` other rows of the greatest inner products of each asked row."""
    spark = vectors.sparkSession
    stored = index(vectors, asked, key, vector)
    found = spark.createDataFrame([], "number long, query_id long, value long, key long")
    for block in query_blocks(stored):
        found = found.unionByName(_answers(spark, stored, block, k))
    order = Window.partitionBy("number").orderBy(F.desc("value"), "key")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", "rank", F.nullif("key", F.lit(X.NULL_KEY)).alias(key), F.col("value").alias("score")
    )
