"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.session import pin, small_side, unpin

#: Links that a task shortens at a time.
PART = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of ``links`` (``a, b``: longs); a component is its smallest node.

    Tasks turn their part of the links into stars under the smallest node, which settles links that fit into
    one part. Otherwise large-star and small-star rounds follow: nodes hang their larger, then their smaller
    neighbours under the smallest node they know, until every link leads to a root. The number of rounds
    grows with the logarithm of the longest chain; each is stored, and the one before dropped.
    """
    edges = pin(links.where(F.col("a") != F.col("b")).select(*_ordered("a", "b")).distinct(), "links")
    while True:
        parts = max(1, -(-edges.count() // PART))
        shorter = pin(edges.coalesce(parts).mapInArrow(_shorten, "a long, b long"), "stars")
        unpin(edges)
        edges = shorter
        if parts == 1:
            break
        stars = pin(_star(_star(edges, larger=True), larger=False), "stars")
        before, now = _digest(edges), _digest(stars)
        unpin(edges)
        edges = stars
        if now == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` (``node, component``) with more ``links``: only components that they touch are looked at (a stored table)."""
    held = small_side(known)
    ends = links
    for end in ("a", "b"):
        of = held.select(F.col("node").alias(end), F.col("component").alias("c"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    moved = pin(components(ends), "moved")
    into = small_side(moved).select(F.col("node").alias("component"), F.col("component").alias("new"))
    old = known.join(into, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return pin(old.unionByName(moved.join(known, "node", "left_anti")), "known")


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars under the smallest nodes, of the links of a task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = np.array([x for x in root if root[x] != x], np.int64)
    tops = np.array([find(x) for x in nodes.tolist()], np.int64)
    for at in range(0, len(nodes), 1 << 16):
        part = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(tops[part]), pa.array(nodes[part])], ["a", "b"])


def _digest(edges: DataFrame) -> tuple:
    """Number and hashes of the (distinct) links: equal for the same set of links."""
    one, two = F.xxhash64("a", "b"), F.xxhash64("b", "a")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(one), F.bit_xor(two)).first())


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's larger (else: smaller and own) neighbours under its smallest one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    hung = both.where(F.col("b") > F.col("a")) if larger else both
    hung = hung.join(least, "a")
    out = hung.select(F.col("m").alias("x"), F.col("b").alias("y"))
    if not larger:
        out = out.unionByName(least.select(F.col("m").alias("x"), F.col("a").alias("y")))
    return out.where("x <> y").select(*_ordered("x", "y")).distinct()
