"""Rows by their place in key order, without ranking keys.

The key at a place is found by narrowing histograms: a sample gives bounds, one pass over the key columns counts
the keys between and at them, and the next pass looks only between the two bounds around the place. So
tasks send counts, never keys; rows are then compared with the key found, and stay where they are.

Keys are ordered column by column, missing values first. Rows that share a key follow the hash of all their
columns, so the same rows are chosen however a table is partitioned; only rows equal in all columns are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from prepkit.operators.positions import names

#: Bounds of a pass, keys sampled for them, and keys few enough to be sorted by the last pass.
BOUNDS, SAMPLE, FEW = 63, 1023, 100_000


def _order(keys: Sequence[str]) -> Column:
    return F.struct(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)))


def _literal(df: DataFrame, keys: Sequence[str], row: Row) -> Column:
    return F.struct(*(F.lit(row[i]).cast(df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)))


def _place(order: Column, bounds: Sequence[Column], first: int = 0) -> Column:
    """2 * i for a key before bound i (and after the one before it), 2 * i + 1 for a key equal to it."""
    if not bounds:
        return F.lit(2 * first)
    mid = len(bounds) // 2
    return (
        F.when(order < bounds[mid], _place(order, bounds[:mid], first))
        .when(order == bounds[mid], F.lit(2 * (first + mid) + 1))
        .otherwise(_place(order, bounds[mid + 1 :], first + mid + 1))
    )


def key_at(df: DataFrame, key: str | Sequence[str], n: int) -> Row | None:
    """The key of row ``n`` (from 1) in key order, or None if there are fewer rows."""
    keys = names(key)
    every = df.select(*(F.col(f"`{k}`") for k in keys))
    order = _order(keys)
    rest, rank, low, high = every, n, None, None
    ascending = [F.asc_nulls_first(f"`{k}`") for k in keys]
    while n > 0:
        drawn = rest.withColumn("__r", F.rand(0)).orderBy("__r").limit(SAMPLE).drop("__r")
        listed = drawn.distinct().orderBy(*ascending).collect()  # at most SAMPLE rows
        if not listed:
            return None
        step = max(1, len(listed) // BOUNDS)
        rows = listed[step // 2 :: step]
        bounds = [_literal(df, keys, r) for r in rows]
        counts = rest.groupBy(_place(order, bounds).alias("at")).agg(F.count(F.lit(1)).alias("n")).orderBy("at").collect()
        for found in counts:
            if rank <= found["n"]:
                break
            rank -= found["n"]
        else:
            return None
        at = found["at"]
        if at % 2:
            return rows[at // 2]
        low = bounds[at // 2 - 1] if at else low
        high = bounds[at // 2] if at // 2 < len(bounds) else high
        rest = every
        rest = rest if low is None else rest.where(order > low)
        rest = rest if high is None else rest.where(order < high)
        if found["n"] <= FEW:
            return rest.orderBy(*ascending).offset(rank - 1).limit(1).first()
    return None


def _tied(df: DataFrame, keys: Sequence[str], edge: Column) -> DataFrame:
    """The rows of a key, in their order."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.where(_order(keys) == edge).orderBy(F.xxhash64(*hashed))


def rows_between(df: DataFrame, key: str | Sequence[str], start: int, end: int | None) -> DataFrame:
    """The rows after the first ``start`` up to row ``end`` in key order; without ``end``, all after ``start``."""
    keys, order = names(key), _order(names(key))
    if end is not None and end <= start:
        return df.limit(0)
    low = key_at(df, keys, start) if start > 0 else None
    if start > 0 and low is None:
        return df.limit(0)
    high = None if end is None else key_at(df, keys, end)

    def before(edge: Row) -> int:
        return df.select(*(F.col(f"`{k}`") for k in keys)).where(order < _literal(df, keys, edge)).count()

    if low is not None and high is not None and low == high:
        edge, skipped = _literal(df, keys, low), start - before(low)
        return _tied(df, keys, edge).offset(skipped).limit(end - start)
    inner, parts = df, []
    if low is not None:
        edge = _literal(df, keys, low)
        parts.append(_tied(df, keys, edge).offset(start - before(low)))
        inner = inner.where(order > edge)
    if high is not None:
        edge = _literal(df, keys, high)
        parts.append(_tied(df, keys, edge).limit(end - before(high)))
        inner = inner.where(order < edge)
    for part in parts:
        inner = inner.unionByName(part)
    return inner
