"""Batches: a key on rows, and padding rules computed per key.

With ``shards`` the rows of a split are spread over that many equal parts and batched inside each:
one shuffle carries the rows, and the padding windows reuse its partitioning. Without it, batches
are consecutive over the whole split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prepkit.operators.positions import global_position, names, order_hash, with_bucket

BATCH = ("split", "shard", "batch_id")
IGNORE = -100


def assign_shards(
    df: DataFrame, key: str | Sequence[str], shards: int, seed: int | None = None
) -> DataFrame:
    """Add ``shard``: equal parts that follow the order of the rows."""
    return with_bucket(df, key, seed, shards, "shard")[0]


def batch_in_shards(
    df: DataFrame,
    key: str | Sequence[str],
    size: int | Column,
    by: str | Sequence[str] = "split",
    seed: int | None = None,
) -> DataFrame:
    """Add ``batch_id, pos`` inside each assigned shard: one shuffle of the rows."""
    order = ([] if seed is None else [order_hash(key, seed)]) + [F.col(k) for k in names(key)]
    inside = W.partitionBy(*names(by), "shard").orderBy(*order)
    return _number(df.withColumn("__at", F.row_number().over(inside)), size)


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    size: int | Column,
    by: str | Sequence[str] = "split",
    shards: int | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Add ``shard, batch_id, pos``: consecutive groups of ``size`` rows, ``pos`` from 0 inside each.

    ``seed`` shuffles the rows reproducibly; without it they keep key order. ``df`` is read twice,
    for its keys and for its rows: store it first if making it is costly.
    """
    if shards is not None:
        return batch_in_shards(assign_shards(df, key, shards, seed), key, size, by, seed)
    return _number(global_position(df, key, seed, by, "__at").withColumn("shard", F.lit(0)), size)


def _number(placed: DataFrame, size: int | Column) -> DataFrame:
    before = F.col("__at") - 1
    return (
        placed.withColumn("batch_id", F.floor(before / size).cast("long"))
        .withColumn("pos", (before % size).cast("int"))
        .drop("__at")
    )


def _longest(col: str, batch: Sequence[str]):
    return F.max(F.size(col)).over(W.partitionBy(*batch))


def pad_to_longest(
    df: DataFrame,
    col: str = "input_ids",
    pad_id: int = 0,
    batch: Sequence[str] = BATCH,
    mask: str | None = "attention_mask",
) -> DataFrame:
    """Pad every row to the longest of its batch; ``mask`` marks the real ids with 1."""
    df = df.withColumn("__width", _longest(col, batch))
    if mask is not None:
        df = df.withColumn(
            mask,
            F.concat(
                F.array_repeat(F.lit(1), F.size(col)),
                F.array_repeat(F.lit(0), F.col("__width") - F.size(col)),
            ),
        )
    fill = F.array_repeat(F.lit(pad_id), F.col("__width") - F.size(col))
    return df.withColumn(col, F.concat(F.col(col), fill)).drop("__width")


def labels_copy(
    df: DataFrame, col: str = "input_ids", mask_padding: bool = False, mask: str = "attention_mask", out: str = "labels"
) -> DataFrame:
    """Labels equal to the padded ids; with ``mask_padding`` the padding becomes -100."""
    if not mask_padding:
        return df.withColumn(out, F.col(col))
    kept = F.zip_with(col, mask, lambda v, m: F.when(m == 1, v).otherwise(F.lit(IGNORE)))
    return df.withColumn(out, kept)


def labels_masked_copy(df: DataFrame, col: str = "input_ids", pad_id: int = 0, out: str = "labels") -> DataFrame:
    """Labels equal to the padded ids with every pad id replaced by -100."""
    return df.withColumn(out, F.transform(col, lambda v: F.when(v == pad_id, F.lit(IGNORE)).otherwise(v)))


def labels_pad_separately(
    df: DataFrame, col: str = "labels", pad_id: int = 0, batch: Sequence[str] = BATCH
) -> DataFrame:
    """Pad labels to their own longest row, without a mask."""
    return pad_to_longest(df, col, pad_id, batch, mask=None)


def labels_pad_to_input(
    df: DataFrame, col: str = "labels", padded: str = "input_ids", ignore: int = IGNORE
) -> DataFrame:
    """Cut or pad labels to the length of the padded ids."""
    width = F.size(padded)
    fill = F.array_repeat(F.lit(ignore), width)
    return df.withColumn(col, F.slice(F.concat(F.col(col), fill), F.lit(1), width))


def pad_labels(df: DataFrame, mode: str, pad_id: int = 0, batch: Sequence[str] = BATCH) -> DataFrame:
    """Apply a label rule by name: ``copy``, ``masked``, ``own`` or ``to_input``."""
    if mode == "copy":
        return labels_copy(df)
    if mode == "masked":
        return labels_masked_copy(df, pad_id=pad_id)
    if mode == "own":
        return labels_pad_separately(df, pad_id=pad_id, batch=batch)
    if mode == "to_input":
        return labels_pad_to_input(df)
    raise ValueError(f"unknown label rule {mode!r}; use copy, masked, own or to_input")


def stack_column(df: DataFrame, col: str, out: str | None = None, batch: Sequence[str] = BATCH) -> DataFrame:
    """One row per batch with the values of ``col`` in row order."""
    rows = F.array_sort(F.collect_list(F.struct("pos", col)))
    return df.groupBy(*batch).agg(F.transform(rows, lambda r: r[col]).alias(out or col))


def stack_labels(df: DataFrame, col: str = "labels", batch: Sequence[str] = BATCH) -> DataFrame:
    return stack_column(df, col, batch=batch)


def stack_pixels(df: DataFrame, col: str = "pixel_values", batch: Sequence[str] = BATCH) -> DataFrame:
    """One row per batch: pixel rows side by side and the shape they share; unequal shapes fail."""
    shape = F.struct("channels", "height", "width")
    stacked = df.withColumn("__shape", shape).groupBy(*batch).agg(
        F.array_sort(F.collect_list(F.struct("pos", col))).alias("__rows"),
        F.min("__shape").alias("__low"),
        F.max("__shape").alias("__high"),
    )
    message = F.lit("images of different shapes in one batch")
    values = F.flatten(F.transform("__rows", lambda r: r[col]))
    alike = F.col("__low") == F.col("__high")
    dtype = df.schema[col].dataType
    return stacked.select(
        *batch,
        F.when(alike, values).otherwise(F.raise_error(message).cast(dtype)).alias(col),
        F.size("__rows").alias("rows"),
        "__low.*",
    )


def batch_stats(df: DataFrame, col: str = "input_ids", batch: Sequence[str] = BATCH) -> DataFrame:
    """Rows, padded width and padded cells per batch, from unpadded ids."""
    length = F.size(col)
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(length).alias("width"),
        (F.max(length) * F.count(F.lit(1)) - F.sum(length)).alias("padded_cells"),
    )
