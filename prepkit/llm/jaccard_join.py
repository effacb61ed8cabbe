"""N-gram Jaccard join by trees over count vectors.

A document's set of 5-word shingles is hashed into groups; how many shingles fall into each group is its
point, with a dimension for every one or two shingles. Two sets cannot share more than the sum of the
smaller of their two counts over all groups, and boxes around points cannot promise more than the sum of
their smaller upper bounds; pairs of boxes and of points that cannot reach the similarity are dropped, the
others are verified shingle by shingle.

No tree holds all points. Sets of a similarity of 0.8 share ``k`` of their first ``n/5 + k`` shingles in any
common order, so there is a tree per such shingle with two or more sets, and a set with fewer than ``k``
trees is in none; shingles that a great many documents hold come last in the order, which keeps shared
passages out of the trees. Each set then leaves its ``k - 1`` largest trees: two that share ``k`` still meet in
one, and fewer meet by chance. Trees with the same members are one tree, trees with the same smallest member
are joined together, by pairs that have a tree in common. Equal sets are one point.

Components are formed in rounds, and boxes whose points belong to one component need no join any more.
First each set is bounded and verified against the smallest member of its trees. Then each component is
verified against the nearest point of another one under each leader, once for two components, until hardly a
pair is a link; so thousands of near copies cost a few verifications each. Points that the bounds leave no
partner after the first step are in no round. At last all pairs between
components that the bounds leave in any tree are verified, so no link depends on the rounds. A round looks at the
components that its links touch only. A tree of many points is joined in pairs of blocks. Texts are read
three times: for the commonest shingles, for the points, and for the whole sets of one document of each point
in a tree, which all rounds verify from.

Defined cases: a text without words or a null text has an empty set, which links with nothing; fewer words
than five are one shingle; rows that share an id are separate sets; a null id is smaller than all others.
Equal shingles and sets are recognised by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm import exchange as X
from prepkit.llm import words as W
from prepkit.llm.components import components, joined
from prepkit.session import pin, short_batches, small_side, temporary_tables, unpin

SHINGLE = 5
#: Similarity as a fraction.
PART, WHOLE = 4, 5
#: Shingles put last in the order of all: at most so many, each met so often in one run of input.
COMMON, COMMON_IN_RUN = 1 << 18, 4
#: Shared shingles asked for: one per so many, up to ``MOST_SHARED``.
SHARED_PER, MOST_SHARED = 16, 8
#: Another round of nearest points is worth it if one pair in so many was a link.
WORTH = 50
#: Parts over which rows of one set are spread when its class comes back to them.
SALTS = 16
#: Points joined at a time, and boxes or points in a box.
BLOCK, FAN = 2048, 8
#: Points handed on at a time.
HANDED = 256

_U = np.uint64


def _row_sets(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted shingle hashes of each row of a batch."""
    for chunk in W.chunks(batch.column(column)):
        found = W.find_words(chunk, W.NOT_SPACE, W.LOWER)
        place, hashes = W.row_windows(found, SHINGLE)
        cut = np.searchsorted(found.row[place], np.arange(chunk.high - chunk.low + 1))
        n = np.diff(found.first)
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        whole = dict(zip(short.tolist(), W.whole_rows(found, short), strict=True))
        for r in range(chunk.high - chunk.low):
            own = np.array([whole[r]], _U) if r in whole else np.unique(hashes[cut[r] : cut[r + 1]])
            yield chunk.low + r, own


def _name(own: np.ndarray) -> int:
    """A set's 64-bit name, whatever the order of its shingles."""
    total = W.mix(own ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)
    return int(W.mix(np.array([total + _U(len(own))], _U)).view(np.int64)[0])


def _groups(n: int) -> int:
    """Groups of a set of ``n`` shingles: a power of two, from 16."""
    return max(16, 1 << max(0, n.bit_length() - 1))


def _point(own: np.ndarray) -> np.ndarray:
    """Counts by group; 255 of one or two expected hashes in a group do not occur."""
    g = _groups(len(own))
    return np.bincount((own >> _U(64 - g.bit_length() + 1)).astype(np.int64), minlength=g).astype(np.uint8)


def _first_size(n: int) -> int:
    """How many first shingles of a set of ``n`` enter the trees."""
    return n - -(-PART * n // WHOLE) + min(MOST_SHARED, max(1, n // SHARED_PER))


def _needed() -> F.Column:
    """How many of the first shingles of a set of ``n`` a similar set shares, which may be smaller by a fifth."""
    least = F.ceil(F.lit(PART) * F.col("n") / F.lit(WHOLE))
    return F.least(F.lit(MOST_SHARED), F.greatest(F.lit(1), F.floor(least / F.lit(SHARED_PER))))


def common_shingles(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The shingles of most documents, rarest first; counted over all rows, at most ``COMMON``."""

    def count(batches):
        held: list[np.ndarray] = []

        def flush():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            many = n >= COMMON_IN_RUN
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["shingle", "n"]
            )

        for batch in batches:
            for _, own in _row_sets(batch, 0):
                held.append(own)
            if sum(map(len, held)) >= X.RUN:
                yield from flush()
        if held:
            yield from flush()

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "shingle long, n long")
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(COMMON).collect()
    return np.array([r["shingle"] for r in reversed(top)], np.int64).view(_U)


def _sets(docs: DataFrame, key: str, text: str, common: np.ndarray) -> DataFrame:
    """``key, n, node, first, point`` of every row: the set's name, its first shingles and its counts."""
    held = docs.sparkSession.sparkContext.broadcast(common)  # at most COMMON values

    def make(batches):
        order = np.argsort(held.value)
        last, rank = held.value[order], order
        for batch in batches:
            n, node, first, point = [], [], [], []
            for _, own in _row_sets(batch):
                n.append(len(own))
                if not len(own):
                    node.append(None)
                    first.append(None)
                    point.append(None)
                    continue
                node.append(_name(own))
                late = X.is_in(own, last)
                listed = own[~late]
                if late.any():
                    ends = own[late]
                    listed = np.concatenate((listed, ends[np.argsort(rank[np.searchsorted(last, ends)])]))
                first.append(X.packed(listed[: _first_size(len(own))]))
                point.append(_point(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(first, pa.binary()), pa.array(point, pa.binary())],
                ["key", "n", "node", "first", "point"],
            )

    cells = docs.select(X.safe_key(key).alias("key"), F.col(text).alias("text"))
    return cells.mapInArrow(make, "key long, n long, node long, first binary, point binary")


def _first_entries(batch):
    """First shingles of a batch of sets, with their sets."""
    cells = [X.unpacked(c) for c in batch.column(1).to_pylist()]
    sizes = [len(c) for c in cells]
    nodes = batch.column(0).to_numpy(zero_copy_only=False)
    yield (np.concatenate(cells) if cells else np.zeros(0, _U)), np.repeat(nodes, sizes)


def _members(shared: DataFrame) -> DataFrame:
    """``tree, node``: the members of each tree of two or more sets."""

    def unfold(batches):
        for batch in batches:
            cells = [X.unpacked(c) for c in batch.column(1).to_pylist()]
            if cells:
                nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(c) for c in cells])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells).view(np.int64)), pa.array(nodes)], ["tree", "node"]
                )

    return shared.mapInArrow(unfold, "tree long, node long")


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose counts allow the similarity."""

    def compare(batches):
        for batch in batches:
            good = []
            for m, n, x, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                width = min(len(x), len(y))
                x, y = _fold(np.frombuffer(x, np.uint8), width), _fold(np.frombuffer(y, np.uint8), width)
                most = int(np.minimum(x, y).sum(dtype=np.int64))
                good.append(WHOLE * m >= PART * n and WHOLE * n >= PART * m and (PART + WHOLE) * most >= PART * (m + n))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda name, n, point: points.select(
        F.col("node").alias(name), F.col("n").alias(n), F.col("point").alias(point)
    )
    joined = pairs.join(of("a", "m", "x"), "a").join(of("b", "n", "y"), "b")
    return joined.select("a", "b", "m", "n", "x", "y").mapInArrow(compare, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` (a stored table) whose ``sets`` (``node, own``) reach the similarity (a stored table)."""
    ends = pin(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "ends")
    used = sets.join(small_side(ends), "node", "left_semi")

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = int(X.is_in(x, y).sum())
                good.append(WHOLE * both >= PART * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Rows that share an id may give a set twice, and so a pair twice; links are made distinct later.
    both = pairs.join(used.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    both = both.join(used.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    links = pin(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "links")
    unpin(ends)
    return links


class CountTree:
    """Boxes over points: upper bounds of counts, bounds of sizes, and the component if there is one only.

    Points are ordered by size, and among those of like size by the group in which they differ most.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, groups: np.ndarray):
        widest = int(np.argmax(points.var(axis=0)))
        self.order = np.lexsort((points[:, widest], sizes // 8))
        level = (points[self.order], sizes[self.order], sizes[self.order], groups[self.order])
        self.levels = [level]
        while len(level[1]) > FAN:
            top, low, high, group = level
            cut = np.arange(0, len(low), FAN)
            least, most = np.minimum.reduceat(group, cut), np.maximum.reduceat(group, cut)
            level = (
                np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(low, cut),
                np.maximum.reduceat(high, cut), np.where(least == most, least, -1),
            )
            self.levels.append(level)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of points of different components that may reach the similarity, and by how much they may."""
        n = len(self.levels[-1][1])
        i, j = np.triu_indices(n)
        for depth in range(len(self.levels) - 1, -1, -1):
            i, j, over = self._possible(self.levels[depth], i, j, points=depth == 0)
            if depth:
                size = len(self.levels[depth - 1][1])
                a = (i[:, None] * FAN + np.arange(FAN))[:, :, None]
                b = (j[:, None] * FAN + np.arange(FAN))[:, None, :]
                a, b = np.broadcast_arrays(a, b)
                a, b = a.ravel(), b.ravel()
                good = (a <= b) & (b < size)
                i, j = a[good], b[good]
        return self.order[i], self.order[j], over

    @staticmethod
    def _possible(level, i: np.ndarray, j: np.ndarray, points: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        top, low, high, group = level
        good = ~((group[i] == group[j]) & (group[i] >= 0))
        good &= (WHOLE * high[i] >= PART * low[j]) & (WHOLE * high[j] >= PART * low[i])
        if points:
            good &= i != j
        i, j = i[good], j[good]
        # |x & y| >= s |x or y| asks for |x & y| >= s / (1 + s) (|x| + |y|).
        need = PART * (low[i] + low[j])
        step = max(1, (1 << 22) // top.shape[1])
        most = np.empty(len(i), np.int64)
        for at in range(0, len(i), step):
            part = slice(at, at + step)
            most[part] = np.minimum(top[i[part]], top[j[part]]).sum(axis=1, dtype=np.int64)
        over = (PART + WHOLE) * most / np.maximum(need, 1)
        good = over >= 1
        return i[good], j[good], over[good]


def _fold(cell: np.ndarray, groups: int) -> np.ndarray:
    """Counts over fewer groups: neighbours are added."""
    return cell.reshape(groups, -1).sum(axis=1, dtype=np.uint16)


def _nearest(i: np.ndarray, j: np.ndarray, over: np.ndarray) -> np.ndarray:
    """Which pairs are the best one of either of their components."""
    best = np.zeros(len(i), bool)
    for side in (i, j):
        order = np.lexsort((-over, side))
        best[order[np.flatnonzero(np.diff(side[order], prepend=-1))]] = True
    return best


def _flags(trees: list[list[int]]) -> np.ndarray:
    """A row of bits for each set: the trees it is in."""
    every, numbers = np.unique(np.concatenate([np.array(t, np.int64) for t in trees]), return_inverse=True)
    out = np.zeros((len(trees), -(-len(every) // 8)), np.uint8)
    np.bitwise_or.at(out, (np.repeat(np.arange(len(trees)), list(map(len, trees))), numbers // 8), np.uint8(1) << (numbers % 8).astype(np.uint8))
    return out


def _meet(flags: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs have a tree in common."""
    out, step = np.zeros(len(i), bool), max(1, (1 << 24) // flags.shape[1])
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        out[part] = (flags[i[part]] & flags[j[part]]).any(axis=1)
    return out


def tree_pairs(
    sizes: np.ndarray,
    components_of: np.ndarray,
    cells: list[np.ndarray],
    blocks: np.ndarray,
    nearest: bool = False,
    trees: list[list[int]] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of sets of one leader that must be verified, and by how much they may reach the similarity.

    With two blocks, pairs across them; with ``trees`` of each set, pairs that have one in common.

    With ``nearest``, of each component only the pair whose bound is best.
    Points have as many groups as their sizes ask for. Sizes of a similar pair differ by a quarter at most,
    so it is enough to join each width with itself and with the next, folded.
    """
    _, numbered = np.unique(components_of, return_inverse=True)
    width = np.array([len(c) for c in cells])
    flags = None if trees is None else _flags(trees)
    for w in np.unique(width):
        own = np.flatnonzero((width == w) | (width == 2 * w))
        if len(own) < 2:
            continue
        points = np.stack([_fold(cells[k], w) for k in own])
        i, j, over = CountTree(points, sizes[own], numbered[own]).pairs()
        i, j = own[i], own[j]
        good = ~((width[i] == 2 * w) & (width[j] == 2 * w))
        if len(np.unique(blocks)) > 1:
            good &= blocks[i] != blocks[j]
        i, j, over = i[good], j[good], over[good]
        if flags is not None:
            good = _meet(flags, i, j)
            i, j, over = i[good], j[good], over[good]
        if nearest:
            best = _nearest(numbered[i], numbered[j], over)
            i, j, over = i[best], j[best], over[best]
        yield i, j, over


def _groups_held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one leader and pair of blocks at a time."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:3] != held[0][:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _column(held: list[tuple], k: int) -> np.ndarray:
    return np.array([r[k] for r in held], np.int64)


def _held_pairs(held: list[tuple], nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``tree_pairs`` of the rows ``leader, p, q, block, node, component, n, point, trees`` of a group."""
    component = _column(held, 5)
    if (component != component[0]).any():
        cells = [np.frombuffer(r[7], np.uint8) for r in held]
        yield from tree_pairs(_column(held, 6), component, cells, _column(held, 3), nearest, [r[8] for r in held])


def _in_groups(rows: DataFrame) -> DataFrame:
    rows = rows.select("leader", "p", "q", "block", "node", "component", "n", "point", "trees")
    return rows.repartition("leader", "p", "q").sortWithinPartitions("leader", "p", "q")


def _placed(members: DataFrame, known: DataFrame, points: DataFrame) -> DataFrame:
    """``leader, p, q, block, node, trees, n, point`` of the sets that may be similar to one of another component (a stored table).

    The trees under a leader mostly have the same members, so they are joined together; ``trees`` are those that a
    member is in. Many members are joined in pairs of blocks: each point meets every block, as one of the first
    or of the second of the pair. Components only grow together, so a point without a possible pair has none later.
    """
    held = members.groupBy("leader", "node").agg(F.sort_array(F.collect_list("tree")).alias("trees"))
    held = pin(held.join(small_side(known), "node", "left").withColumn("component", F.coalesce("component", "node")), "held")
    count = held.groupBy("leader").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = held.join(count.where("low <> high").select("leader", "size"), "leader")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    mixed = mixed.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    mixed = mixed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mixed = mixed.select(
        "leader", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "node", "component",
        "trees",
    )
    rows = _in_groups(mixed.join(points, "node"))
    names = ["leader", "p", "q", "block", "node", "trees", "n", "point"]
    shape = rows.select(*names).schema
    at = [rows.columns.index(name) for name in names]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]

    def possible(batches):
        for group in _groups_held(batches):
            some = np.zeros(len(group), bool)
            for i, j, _ in _held_pairs(group, nearest=False):
                some[i] = some[j] = True
            left = [group[k] for k in np.flatnonzero(some)]
            for first in range(0, len(left), HANDED):
                columns = list(zip(*left[first : first + HANDED], strict=True))
                cells = [pa.array(columns[k], kind) for k, kind in zip(at, types, strict=True)]
                yield pa.RecordBatch.from_arrays(cells, names)

    placed = pin(rows.mapInArrow(possible, shape), "placed")
    unpin(held)
    return placed


def _candidates(placed: DataFrame, known: DataFrame, nearest: bool) -> DataFrame:
    """``a, b``: pairs of sets of different components that the trees cannot tell apart (a stored table).

    With ``nearest``, of two components only the pair whose bound is best.
    """
    rows = placed.join(small_side(known), "node", "left").withColumn("component", F.coalesce("component", "node"))

    def join(batches):
        for held in _groups_held(batches):
            node, component = _column(held, 4), _column(held, 5)
            for i, j, over in _held_pairs(held, nearest):
                swap = node[i] > node[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                columns = (node[i], node[j], np.minimum(component[i], component[j]), np.maximum(component[i], component[j]), over)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "low", "high", "over"])

    found = _in_groups(rows).mapInArrow(join, "a long, b long, low long, high long, over double")
    if nearest:
        best = F.max_by(F.struct("a", "b"), F.struct("over", "a", "b")).alias("best")
        return pin(found.groupBy("low", "high").agg(best).select("best.*"), "pairs")
    return pin(found.select("a", "b").distinct(), "pairs")


def _round(placed: DataFrame, known: DataFrame, sets: DataFrame, nearest: bool) -> tuple[DataFrame, int, int]:
    """The components after a round, the number of links it found, and that of the pairs it tried."""
    pairs = _candidates(placed, known, nearest)
    links = _verified(pairs, sets)
    tried, n = pairs.count(), links.count()
    after = joined(known, links) if n else known
    unpin(pairs, links, *([known] if n else []))
    return after, n, tried


def _met(nodes: DataFrame, first: DataFrame, ranges: int) -> DataFrame:
    """``tree, node``: sets that have enough of their first shingles in common with others (a stored table)."""
    shared = X.shared_hashes(first, _first_entries, ranges)
    enough = shared.withColumnRenamed("key", "node").join(nodes.select("node", "n"), "node")
    return pin(_members(enough.where(F.octet_length("hashes") >= 8 * _needed()).select("node", "hashes")), "members")


def _trees(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``tree, node, leader``: members of the trees (a stored table), and the smallest of each tree."""
    counts = nodes.select("node", "n")
    # Sets that had too few trees have left trees with one member, and so on; once more is worth it.
    several = pin(members.join(members.groupBy("tree").count().where("count > 1").select("tree"), "tree"), "several")
    unpin(members)
    enough = several.groupBy("node").count().join(counts, "node").where(F.col("count") >= _needed()).select("node")
    members = pin(several.join(enough, "node", "left_semi"), "members")
    unpin(several)
    lists = members.groupBy("tree").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"), F.min("node").alias("leader"),
    ).where("size > 1")
    trees = lists.groupBy("size", "x", "y", "leader").agg(F.min("tree").alias("tree"), F.count(F.lit(1)).alias("alike"))
    left = pin(_left(members.join(trees.select("tree", "size", "alike"), "tree"), counts), "left")
    leaders = left.groupBy("tree").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader"))
    out = pin(left.join(leaders.where("size > 1").select("tree", "leader"), "tree"), "trees")
    unpin(members, left)
    return out


def _left(members: DataFrame, counts: DataFrame) -> DataFrame:
    """``tree, node``: the members (``tree, node, size, alike``) without the largest trees of each set.

    Two similar sets have as many trees in common as either needs (``alike``: trees with these members). If each
    leaves its largest trees, in one order for all and fewer than it needs, what either has left of their common
    ones comes first in that order and is less than they have: they still meet in the last.
    """
    order = Window.partitionBy("node").orderBy(F.desc("size"), "tree").rowsBetween(Window.unboundedPreceding, 0)
    ranked = members.join(counts, "node").withColumn("upto", F.sum("alike").over(order))
    return ranked.where(F.col("upto") >= _needed()).select("tree", "node")


def _components(docs: DataFrame, key: str, text: str, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``node, component`` of the sets that have links (a stored table)."""
    wanted = pin(members.select("node").distinct(), "wanted")
    points = pin(nodes.join(small_side(wanted), "node", "left_semi").select("node", "n", "point"), "points")
    ids = pin(nodes.join(small_side(wanted), "node", "left_semi").select(F.col("least").alias("key")).distinct(), "ids")
    cells = docs.select(X.safe_key(key).alias("key"), F.col(text).alias("text"))
    sets = pin(cells.join(small_side(ids), "key", "left_semi").mapInArrow(_whole, "node long, own binary"), "whole")
    pairs = members.groupBy("node").agg(F.min("leader").alias("a")).where("a < node")
    pairs = pin(_bounded(pairs.select("a", F.col("node").alias("b")), points), "pairs")
    links = _verified(pairs, sets)
    known = pin(components(links), "known")
    placed = _placed(members, known, points)
    unpin(pairs, links, wanted, ids, points)
    found = tried = 1
    while found * WORTH >= max(tried, 1):
        known, found, tried = _round(placed, known, sets, nearest=True)
    # Hardly a component's nearest is similar: all that the bounds leave are tried, once.
    return _round(placed, known, sets, nearest=False)[0]


def link_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` of every row; a component's id is its smallest key."""
    short_batches(docs.sparkSession)
    with temporary_tables(docs.sparkSession) as kept:
        stored = pin(_sets(docs, key, text, common_shingles(docs, text)), "sets")
        base = pin(stored.select("key", "n", "node"), "base")
        filled = stored.where("n > 0")
        # Copies of a set are brought together by partial aggregates, before anything is joined by it.
        nodes = pin(
            filled.groupBy("node").agg(
                F.min("key").alias("least"), F.max("n").alias("n"), F.max("point").alias("point"), F.count(F.lit(1)).alias("copies")
            ),
            "nodes",
        )
        expected = stored.agg(F.sum(F.octet_length("first"))).first()[0] or 0
        members = _met(nodes, filled.select("node", "first"), X.range_count(docs, expected // 8))
        unpin(stored)
        members = _trees(nodes, members)
        known = _components(docs, key, text, nodes, members)
        least = nodes.select("node", "least", "copies")
        named = least.join(small_side(known), "node", "left").where("copies > 1 or component is not null")
        named = named.withColumn("component", F.coalesce("component", "node"))
        classes = named.groupBy("component").agg(F.min("least").alias("component_id"))
        named = pin(named.join(classes, "component").select("node", "component_id"), "named")
        kept += [base, named]
    # A third of all rows may be one set: they are spread before its class comes to them, and empty sets stay aside.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    held = small_side(named.withColumn("salt", salts))
    salted = base.where("node is not null").withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    out = salted.join(held, ["node", "salt"], "left").select("key", "n", "component_id")
    none = F.lit(None).cast("long").alias("component_id")
    out = out.unionByName(base.where("node is null").select("key", "n", none))
    out = out.withColumn("component_id", F.coalesce("component_id", "key"))
    null = F.lit(X.NULL_KEY)
    return out.select(
        F.nullif("key", null).alias(key), F.col("n").alias("n_shingles"), F.nullif("component_id", null).alias("component_id")
    )


def _whole(batches):
    for batch in batches:
        names, own = [], []
        for _, shingles in _row_sets(batch):
            if len(shingles):
                names.append(_name(shingles))
                own.append(shingles.astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(own, pa.binary())], ["node", "own"])


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each class, the rows of its smallest key, all columns unchanged; of rows equal in key and text, one.

    Texts are shuffled only if the kept keys are too many to broadcast, and for keys that several rows share.
    """
    classes = pin(link_classes(docs, key, text), "classes")
    kept = classes.where(F.col("component_id").eqNullSafe(F.col(key))).groupBy(X.safe_key(key).alias("_kept"))
    kept = pin(kept.agg(F.count(F.lit(1)).alias("n")), "kept")
    alone = small_side(kept.where("n = 1").select("_kept"))
    several = small_side(kept.where("n > 1").select("_kept"))
    once = docs.join(alone, X.safe_key(key) == F.col("_kept"), "left_semi")
    more = docs.join(several, X.safe_key(key) == F.col("_kept"), "left_semi").dropDuplicates([key, text])
    return once.unionByName(more)
