"""Cutting a validation part off a table, and taking its first rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prepkit.operators.positions import order_hash
from prepkit.operators.selection import rows_between

TRAIN, VALIDATION = "train", "validation"
HASH_DIGITS = 32
FEW_ROWS = 1_000_000


def boundary_hash(df: DataFrame, key: str | Sequence[str], seed: int, fraction: float) -> str | None:
    """The order hash of row number ``ceil(fraction * n)``, found by narrowing histograms.

    Each pass reads the key columns only and groups by leading digits of the hash, at most 65,536
    new groups; a pass over single hashes comes when few enough are left.
    """
    hashed = df.select(order_hash(key, seed).alias("h"))
    upto = W.orderBy("d").rowsBetween(W.unboundedPreceding, 0)
    prefix, rank, digits = "", None, 4
    while True:
        counts = (
            hashed.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, digits).alias("d"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("total", F.sum("n").over(upto))
        )
        if rank is None:
            wanted = F.ceil(F.lit(fraction) * F.sum("n").over(W.partitionBy()))
            counts = counts.withColumn("rank", wanted)
        else:
            counts = counts.withColumn("rank", F.lit(rank))
        cut = counts.where((F.col("total") >= F.col("rank")) & (F.col("rank") > 0)).orderBy("d").first()
        if cut is None:
            return None
        prefix, rank = cut["d"], cut["rank"] - (cut["total"] - cut["n"])
        if digits == HASH_DIGITS:
            return prefix
        digits = HASH_DIGITS if cut["n"] <= FEW_ROWS else min(digits + 4, HASH_DIGITS)


def split_exact(
    df: DataFrame, key: str | Sequence[str], fraction: float = 0.15, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Label ``ceil(fraction * n)`` rows as validation and the rest as train, by seeded order.

    The rows are not shuffled: the boundary hash is found first, then compared row by row. Rows
    sharing a key always land on the same side.
    """
    edge = boundary_hash(df, key, seed, fraction)
    if edge is None:
        return df.withColumn(out, F.lit(TRAIN))
    return df.withColumn(
        out, F.when(order_hash(key, seed) <= edge, F.lit(VALIDATION)).otherwise(F.lit(TRAIN))
    )


def split_hash(
    df: DataFrame, key: str | Sequence[str], fraction: float = 0.15, seed: int = 42, out: str = "split"
) -> DataFrame:
    """As ``split_exact`` with an approximate size and no extra pass: one comparison per row."""
    edge = f"{math.floor(fraction * 2**32):08x}"
    lead = F.substring(order_hash(key, seed), 1, 8)
    return df.withColumn(out, F.when(lead <= edge, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)))


def head_n(df: DataFrame, key: str | Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in key order, missing keys first; all rows if there are fewer or ``n`` is None.

    The key of row ``n`` is found by counts over the key columns; rows up to it are then filtered, not
    shuffled. Of the rows that share that key, the first by the hash of all columns stay.
    """
    return df if n is None else rows_between(df, key, 0, max(0, n))


def head_per_split(
    df: DataFrame, key: str | Sequence[str], limits: dict[str, int | None], split: str = "split"
) -> DataFrame:
    """``head_n`` on each split by its own limit; splits without a limit, and rows without a split, stay whole."""
    limits = {name: n for name, n in limits.items() if n is not None}
    if not limits:
        return df
    rest = df.where(F.coalesce(~F.col(split).isin(*limits), F.lit(True)))
    for name, n in limits.items():
        rest = rest.unionByName(head_n(df.where(F.col(split) == name), key, n))
    return rest
