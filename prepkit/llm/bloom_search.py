"""Ranked lexical search over bit-sliced Bloom signatures, exact by rescoring all that is not excluded.

Each document has a Bloom filter of its terms; a term met ``tf`` times is entered at levels 0, 1, 2, 3 ... for
one, two, up to four, up to eight ... occurrences. Documents whose filters have the same width lie side by
side in a block, which is stored by slices: one bitmap over its documents for each bit of the filter. The
slices of a term's bits, met bit by bit, give the documents that may hold it and how often they may at most,
never too few. A term's weight times the score of that many occurrences, summed over an item's terms, is an
upper bound of a document's score.

The documents of the greatest bounds are scored first, by their texts. The score of the last place among
them is a floor for the result; every document whose bound reaches the floor is then scored by its text.
The rest is proved to be outside, whatever false positives the filters have.

Three kinds of passes read the texts: one makes the index, one counts the documents that hold the terms of
the items, two score the documents chosen. Items come in blocks of bounded size, so that what is broadcast
is bounded; the index serves all blocks. Tasks keep the best ``k`` per item, so neither a group of equal
documents nor a term that all documents hold gathers anywhere. Ids of chosen documents are broadcast only
below a measured size.

Defined cases: a null or empty text, or one without terms, is no document and is never found; an item
without terms has no results; items that share an id are ranked separately, under the same id; documents
that share an id are separate documents; a null id is the smallest; equal scores are ranked by id; a text of
any length is indexed whole, in a filter as wide as it asks for; empty tables give no rows; other columns, whatever
their names, are not read. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepkit.llm import exchange as X
from prepkit.llm import words as W
from prepkit.session import pin, small_side

#: Bits of a filter for each entry, at least, and bits set by an entry.
BITS, HASHES = 8, 4
#: Documents and bits of a block, at most (a document needing more bits shares them with seven others).
ROWS, BLOCK_BITS = 1024, 1 << 23
#: Items and their distinct terms handled at a time; one item with more terms makes a block of its own.
ITEMS, TERMS = 512, 1 << 15
#: Documents scored first, for each place of the result.
PROBES = 4
#: Terms summed at a time, and results held before the best are kept.
STEP, HELD = 1024, 1 << 18

_U = np.uint64
_I = np.int64


class Items(NamedTuple):
    """A block of items: their ids, sorted term hashes, and for each item the numbers of its terms."""

    ids: list
    terms: np.ndarray
    of_item: list[np.ndarray]


class Scoring(NamedTuple):
    """A term's weight, by number of term, and the corpus counts."""

    weights: np.ndarray
    documents: int
    total: int

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length figure of documents of ``n`` terms."""
        return 50 + (50 * n * self.documents) // self.total


def part_of(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What ``tf`` occurrences add, in parts of the weight; it never falls as ``tf`` grows."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _entries(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, term counts of the rows, and row, hash and occurrences of distinct terms."""
    for chunk in W.chunks(batch.column(column)):
        found = W.find_words(chunk, W.LETTERS, W.LOWER)
        order = np.lexsort((found.hash, found.row))
        row, term = found.row[order], found.hash[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        begin = np.flatnonzero(fresh)
        yield chunk.low, np.diff(found.first), row[begin], term[begin], np.diff(np.append(begin, len(row)))


def places(terms: np.ndarray, level: int | np.ndarray, width: int) -> np.ndarray:
    """Bits of a filter of ``width`` (a power of two) that the terms set at a level: one row each."""
    h = W.mix(terms + np.asarray(level).astype(_U) * _U(0x9E3779B97F4A7C15))
    step = (h >> _U(32)) | _U(1)
    return ((h[:, None] + np.arange(HASHES, dtype=_U) * step[:, None]) & _U(width - 1)).astype(_I)


def _levels(tf: np.ndarray) -> np.ndarray:
    """The highest level of so many occurrences."""
    return np.ceil(np.log2(tf)).astype(_I)


def sliced(width: int, rows: np.ndarray, terms: np.ndarray, tf: np.ndarray, n_rows: int) -> np.ndarray:
    """Slices (bits by documents, eight to a byte) of the terms of ``n_rows`` documents."""
    stride = -(-n_rows // 8)
    out = np.zeros(width * stride, np.uint8)
    highest = _levels(tf)
    times = highest + 1
    which = np.repeat(np.arange(len(rows)), times)
    level = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    at = places(terms[which], level, width) * stride + (rows[which] // 8)[:, None]
    bit = rows[which] % 8
    for b in range(8):
        own = at[bit == b].ravel()
        out[own] |= np.uint8(1 << b)  # the same bit wherever a place is met twice
    return out.reshape(width, stride)


INDEX = "width long, n_docs long, n_terms long, keys binary, counts binary, slices binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple]] = {}
    size: dict[int, int] = {}

    def flush(width: int) -> pa.RecordBatch:
        keys, counts, terms, tf = zip(*held.pop(width), strict=True)
        size.pop(width)
        rows = np.repeat(np.arange(len(keys)), [len(t) for t in terms])
        slices = sliced(width, rows, np.concatenate(terms), np.concatenate(tf), len(keys))
        counts = np.array(counts, _I)
        return pa.RecordBatch.from_pydict(
            {
                "width": pa.array([width], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()),
                "n_terms": pa.array([counts.sum()], pa.int64()), "keys": pa.array([np.array(keys, _I).tobytes()], pa.binary()),
                "counts": pa.array([counts.tobytes()], pa.binary()), "slices": pa.array([slices.tobytes()], pa.binary()),
            }
        )

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for low, counts, row, term, tf in _entries(batch, 1):
            cut = np.searchsorted(row, np.arange(len(counts) + 1))
            entries = np.concatenate(([0], np.cumsum(_levels(tf) + 1)))[cut]
            for r in np.flatnonzero(counts):
                a, b = cut[r], cut[r + 1]
                width = max(64, 1 << int(BITS * (entries[r + 1] - entries[r]) - 1).bit_length())
                held.setdefault(width, []).append((keys[low + r], counts[r], term[a:b].copy(), tf[a:b].copy()))
                size[width] = size.get(width, 0) + 1
                if size[width] >= max(8, min(ROWS, BLOCK_BITS // width)):
                    yield flush(width)
    for width in sorted(held):
        yield flush(width)


class Best:
    """The best ``k`` of each item: greatest values, of equal ones the smallest keys."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, item: np.ndarray, value: np.ndarray, key: np.ndarray) -> None:
        if len(item):
            self.held.append((item, value, key))
            self.size += len(item)
            if self.size > HELD:
                self._keep()

    def _keep(self) -> None:
        item, value, key = (np.concatenate(c) for c in zip(*self.held, strict=True))
        order = np.lexsort((key, -value, item))
        item = item[order]
        begin = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        rank = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
        order = order[rank < self.k]
        self.held = [(item[rank < self.k], value[order], key[order])]
        self.size = len(order)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._keep()
            for at in range(0, self.size, 1 << 16):
                columns = [pa.array(c[at : at + (1 << 16)].astype(_I)) for c in self.held[0]]
                yield pa.RecordBatch.from_arrays(columns, ["item", "value", "key"])


FOUND = "item long, value long, key long"


def bounds(items: Items, scoring: Scoring, width: int, counts: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores, by item and document of a block."""
    m = scoring.lengths(counts)
    out = np.zeros((len(items.ids), len(counts)), _I)
    for at in range(0, len(items.terms), STEP):
        terms = items.terms[at : at + STEP]
        alive, bitmap = np.arange(len(terms)), None
        level = np.zeros((len(terms), len(counts)), np.uint8)
        depth = 0
        while len(alive):
            met = np.bitwise_and.reduce(slices[places(terms[alive], depth, width)], axis=1)
            bitmap = met if bitmap is None else bitmap & met
            some = bitmap.any(axis=1)
            alive, bitmap = alive[some], bitmap[some]
            level[alive] += np.unpackbits(bitmap, axis=1, count=len(counts), bitorder="little")
            depth += 1
        most = np.minimum(counts, _I(1) << np.arange(max(depth, 1), dtype=_I)[:, None])
        parts = np.concatenate((np.zeros((1, len(counts)), _I), part_of(most, m)))
        added = scoring.weights[at : at + STEP, None] * parts[level, np.arange(len(counts))]
        for i, own in enumerate(items.of_item):
            a, b = np.searchsorted(own, (at, at + STEP))
            if a < b:
                out[i] += added[own[a:b] - at].sum(axis=0)
    return out


def _blocks(batch: pa.RecordBatch):
    names = ("width", "keys", "counts", "slices")
    for width, keys, counts, slices in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
        yield width, np.frombuffer(keys, _I), np.frombuffer(counts, _I), np.frombuffer(slices, np.uint8).reshape(width, -1)


def _most_promising(index: DataFrame, items, scoring, k: int) -> DataFrame:
    """``item, value, key``: of each task the documents of the greatest bounds of each item."""

    def pick(batches):
        best = Best(k)
        for batch in batches:
            for width, keys, counts, slices in _blocks(batch):
                bound = bounds(items.value, scoring.value, width, counts, slices)
                if len(keys) > k:
                    least = np.partition(bound, len(keys) - k, axis=1)[:, len(keys) - k]
                    i, r = np.nonzero((bound >= np.maximum(least, 1)[:, None]))
                else:
                    i, r = np.nonzero(bound)
                best.add(i, bound[i, r], keys[r])
        yield from best.rows()

    return index.mapInArrow(pick, FOUND)


def _not_excluded(index: DataFrame, items, scoring, floors: np.ndarray) -> DataFrame:
    """``key``: documents whose bound reaches the floor of an item."""

    def test(batches):
        for batch in batches:
            for width, keys, counts, slices in _blocks(batch):
                bound = bounds(items.value, scoring.value, width, counts, slices)
                some = (bound >= floors[:, None]).any(axis=0)
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some])], ["key"])

    return index.mapInArrow(test, "key long").distinct()


def _scored(cells: DataFrame, keys: DataFrame, items, scoring, floors: np.ndarray, k: int) -> DataFrame:
    """``item, value, key``: exact scores, at least the floors, of the texts of ``keys``; the best of each task."""

    def score(batches):
        best = Best(k)
        terms, weights = items.value.terms, scoring.value.weights
        of_term = [np.zeros(0, _I)] * len(terms)
        sizes = np.array([len(own) for own in items.value.of_item])
        item = np.repeat(np.arange(len(sizes)), sizes)
        number = np.concatenate(items.value.of_item) if len(sizes) else np.zeros(0, _I)
        order = np.argsort(number, kind="stable")
        of_term, first = item[order], np.searchsorted(number[order], np.arange(len(terms) + 1))
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            for low, counts, row, term, tf in _entries(batch, 1):
                at = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
                own = terms[at] == term
                row, at, tf = row[own], at[own], tf[own].astype(_I)
                added = weights[at] * part_of(tf, scoring.value.lengths(counts.astype(_I))[row])
                times = first[at + 1] - first[at]
                which = np.repeat(np.arange(len(at)), times)
                place = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + first[at[which]]
                pair, inverse = np.unique(row[which] * len(sizes) + of_term[place], return_inverse=True)
                total = np.zeros(len(pair), _I)
                np.add.at(total, inverse, added[which])
                i, r = pair % max(1, len(sizes)), pair // max(1, len(sizes))
                good = total >= floors[i]
                best.add(i[good], total[good], names[low + r[good]])
        yield from best.rows()

    return cells.join(small_side(keys), "key", "left_semi").mapInArrow(score, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item over all tasks, with their ``rank``."""
    order = Window.partitionBy("item").orderBy(F.desc("value"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _document_counts(cells: DataFrame, terms, n_terms: int) -> np.ndarray:
    """How many documents hold each of the terms."""

    def count(batches):
        total = np.zeros(n_terms, _I)
        for batch in batches:
            for _, _, _, term, _ in _entries(batch, 1):
                at = np.minimum(np.searchsorted(terms.value, term), n_terms - 1)
                total += np.bincount(at[terms.value[at] == term], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    out = np.zeros(n_terms, _I)
    for row in cells.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["term"]] = row["n"]
    return out


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """The items with terms, in blocks of bounded size."""
    ids: list = []
    held: list[np.ndarray] = []

    def block() -> Items:
        terms = np.unique(np.concatenate(held))
        return Items(list(ids), terms, [np.searchsorted(terms, own) for own in held])

    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        batch = pa.RecordBatch.from_arrays([pa.array([row["text"]], pa.string())], ["text"])
        for _, _, _, own, _ in _entries(batch, 0):
            if not len(own):
                continue
            if held and (len(held) == ITEMS or sum(map(len, held)) + len(own) > TERMS):
                yield block()
                ids, held = [], []
            ids.append(row["key"])
            held.append(own)
    if held:
        yield block()


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: blocks of bit-sliced filters with the ids and term counts of their documents."""
    return pin(_cells(docs, key, text).mapInArrow(_index, INDEX), "signatures")


def _cells(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(X.safe_key(key).alias("key"), F.col(text).alias("text"))


def _search(spark: SparkSession, cells: DataFrame, index: DataFrame, block: Items, totals, k: int) -> DataFrame:
    context = spark.sparkContext
    terms = context.broadcast(block.terms)
    df = _document_counts(cells, terms, len(block.terms))
    n, total = totals
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], _I)
    items, scoring = context.broadcast(block), context.broadcast(Scoring(weights, n, total))
    floors = np.ones(len(block.ids), _I)
    probes = _top(_most_promising(index, items, scoring, PROBES * k), PROBES * k).select("key").distinct()
    first = _top(_scored(cells, pin(probes, "probes"), items, scoring, floors, k), k)
    for row in first.where(F.col("rank") == k).select("item", "value").collect():  # one row an item of the block
        floors[row["item"]] = row["value"]
    chosen = pin(_not_excluded(index, items, scoring, floors), "chosen")
    return _top(_scored(cells, chosen, items, scoring, floors, k), k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item the ``k`` documents of the greatest scores above 0."""
    spark = docs.sparkSession
    cells = _cells(docs, key, text)
    index = signatures(docs, key, text)
    n, total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    kind = items.schema[item_key].dataType.simpleString()
    out = spark.createDataFrame([], f"`{item_key}` {kind}, rank int, `{key}` long, score long")
    for block in item_blocks(items, item_key, item_text) if n else ():
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, name {kind}")
        found = _search(spark, cells, index, block, (n, total), k).join(F.broadcast(names), "item")
        named = found.select(
            F.col("name").alias(item_key), "rank", F.nullif("key", F.lit(X.NULL_KEY)).alias(key), F.col("value").alias("score")
        )
        out = out.unionByName(named)
    return out
