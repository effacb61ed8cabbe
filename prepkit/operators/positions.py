"""Exact positions in a total order, without sorting a table in one task.

Rows get a bucket number that grows with the order, either from a seeded hash of the row key or,
for stored order, from the key's own value. Bucket sizes are summed up (a table bounded by the
number of buckets), and a row's position is its bucket's offset plus its rank inside the bucket.
The row key must be unique: rows with equal keys have no order between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.session import pin, pin_ordered, small_side

HASH_BUCKETS = 16**4
RANGE_BUCKETS = 4096
RANGE_ROWS = 250_000
SHARD_DIGITS = 8
SAMPLE_PER_BUCKET = 64


def names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(key: str | Sequence[str], seed: int) -> Column:
    """Hex digest whose order is the seeded random order of the rows."""
    parts = [F.col(k).cast("string") for k in names(key)]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *parts)))


def with_bucket(
    df: DataFrame, key: str | Sequence[str], seed: int | None, buckets: int, out: str
) -> tuple[DataFrame, list[Column]]:
    """Add bucket numbers 0..buckets-1 that follow the order; also return the order itself."""
    keys = names(key)
    order = [F.col(k) for k in keys]
    if seed is not None:
        digits = 4 if buckets <= HASH_BUCKETS else SHARD_DIGITS
        if buckets > 16**digits:
            raise ValueError(f"at most {16**digits} hash buckets")
        h = order_hash(keys, seed)
        first = F.conv(F.substring(h, 1, digits), 16, 10).cast("long")
        bucket = F.floor(first * buckets / 16**digits).cast("int")
        return df.withColumn(out, bucket), [h, *order]
    if _is_number(df, keys):
        return _by_quantiles(df, keys[0], buckets, out), order
    # Any other order: sort into a stored copy and number its partitions.
    ranged = pin_ordered(df.repartitionByRange(buckets, *[F.asc_nulls_first(k) for k in keys]))
    return ranged.withColumn(out, F.spark_partition_id()), order


def _is_number(df: DataFrame, keys: list[str]) -> bool:
    return len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.NumericType)


def _by_quantiles(df: DataFrame, key: str, buckets: int, out: str) -> DataFrame:
    """Range buckets between quantiles of a sample; the sample grows with the buckets, not the data.

    Null keys come first, with the smallest ones, and values that are no numbers last.
    """
    if buckets < 2:
        return df.withColumn(out, F.lit(0))
    value = F.col(key).cast("double")
    keys = df.select(value.alias("k")).where(value.isNotNull() & ~F.isnan(value))
    share = min(1.0, SAMPLE_PER_BUCKET * buckets / max(1, keys.count()))
    drawn = keys if share == 1.0 else keys.sample(share, seed=0)
    steps = [i / buckets for i in range(1, buckets)]
    inner = drawn.approxQuantile("k", steps, 1 / (4 * buckets))
    edges = [float("-inf"), *sorted(set(inner)), float("inf")]
    cut = Bucketizer(splits=edges, inputCol="__k", outputCol=out)
    shown = F.when(value.isNull(), F.lit(float("-inf"))).when(F.isnan(value), F.lit(float("inf"))).otherwise(value)
    return cut.transform(df.withColumn("__k", shown)).drop("__k").withColumn(out, F.col(out).cast("int"))


def bucket_count(df: DataFrame, key: str | Sequence[str], seed: int | None) -> int:
    """Buckets for exact positions: a bounded number.

    A range bucket holds about ``RANGE_ROWS`` rows, or more where ``RANGE_BUCKETS`` of them do not do;
    a task then sorts its bucket with spilling.
    """
    if seed is not None:
        return HASH_BUCKETS
    if _is_number(df, names(key)):
        return max(1, min(RANGE_BUCKETS, -(-df.count() // RANGE_ROWS)))
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_position(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int | None = None,
    by: str | Sequence[str] = (),
    out: str = "position",
) -> DataFrame:
    """Add the 1-based position of every row, counted per ``by`` (a few values, such as splits)."""
    by = names(by)
    df, order = with_bucket(df, key, seed, bucket_count(df, key, seed), "__bucket")
    sizes = df.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*by).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = W.partitionBy(*by, "__bucket").orderBy(*order)
    renamed = offsets.select(*(F.col(c).alias(f"__by_{c}") for c in [*by, "__bucket"]), "__offset")
    same = [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in [*by, "__bucket"]]
    # At most `buckets` offsets per value of `by`; their size is measured, since `by` is the caller's choice.
    return (
        df.join(small_side(pin(renamed, "offsets")), same)
        .withColumn(out, F.col("__offset") + F.row_number().over(inside))
        .drop("__bucket", "__offset", *renamed.columns)
    )


def shard_count(df: DataFrame, rows_per_shard: int) -> int:
    """Shards that hold about ``rows_per_shard`` rows each: their number follows that of the rows."""
    return max(1, -(-df.count() // rows_per_shard))
