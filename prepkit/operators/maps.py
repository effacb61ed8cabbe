"""User functions over batches of rows, single rows, and collated batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 16 * 1024 * 1024


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: T.StructType | str,
    batch_size: int = 1000,
    num_partitions: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Apply ``fn`` to batches given as a dict of column lists; its result makes the output rows.

    Only ``columns`` reach the Python workers. Batches have ``batch_size`` rows, but for the last one of
    each partition, whatever the size of Arrow batches; their borders are not stable between runs.
    """
    if num_partitions:
        df = df.repartition(num_partitions)
    if columns is not None:
        df = df.select(*columns)
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def apply(rows: pa.Table) -> pa.RecordBatch:
            result = fn(rows.to_pydict())
            return pa.RecordBatch.from_arrays([pa.array(result[f.name], type=f.type) for f in arrow], schema=arrow)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < batch_size:
                continue
            rows = pa.Table.from_batches(held)
            whole = rows.num_rows - rows.num_rows % batch_size
            for start in range(0, whole, batch_size):
                yield apply(rows.slice(start, batch_size))
            held = rows.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield apply(pa.Table.from_batches(held))

    return df.mapInArrow(run, target)


def add_columns(
    df: DataFrame,
    cols: Sequence[str],
    added: str,
    fn: Callable[[Iterator[tuple]], Iterator[tuple]],
    max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Add the columns ``added``, computed by ``fn`` from an iterator over the cells of ``cols``.

    For large cells: results leave the worker in batches of about ``max_bytes``. The rows pass
    through Python, so drop unused columns first; later filters stay behind this step.
    """
    fresh = df.sparkSession.createDataFrame([], added).schema
    target = T.StructType([*df.schema.fields, *fresh.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(fresh)]
        names = target.names

        def emit(batch: pa.RecordBatch, start: int, rows: list[tuple]) -> pa.RecordBatch:
            made = [pa.array(list(column), type=t) for column, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays([*batch.slice(start, len(rows)).columns, *made], names=names)

        for batch in batches:
            cells = zip(*[(v.as_py() for v in batch.column(c)) for c in cols], strict=True)
            start, rows, size = 0, [], 0
            for row in fn(cells):
                rows.append(row)
                size += sum(map(_cell_bytes, row))
                if size >= max_bytes:
                    yield emit(batch, start, rows)
                    start, rows, size = start + len(rows), [], 0
            if rows:
                yield emit(batch, start, rows)

    return df.mapInArrow(run, target)


def _cell_bytes(value: object) -> int:
    if isinstance(value, dict):
        return sum(map(_cell_bytes, value.values()))
    if isinstance(value, bytes | str):
        return len(value)
    return getattr(value, "nbytes", 8)


def map_rows(df: DataFrame, fn: Callable[..., object], dtype: T.DataType | str, out: str, *cols: str) -> DataFrame:
    """Add ``out = fn(*cols)`` row by row, sent to Python in Arrow batches.

    For what column expressions cannot say; list columns arrive as arrays.
    """

    @F.pandas_udf(dtype)
    def apply(*series: pd.Series) -> pd.Series:
        return pd.Series([fn(*row) for row in zip(*series, strict=True)], dtype=object)

    return df.withColumn(out, apply(*cols))


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which ``condition`` holds; simple conditions reach the scan."""
    return df.where(condition)


def collate_fn(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    batch: Sequence[str] = ("split", "shard", "batch_id"),
) -> DataFrame:
    """Apply ``fn`` to the rows of each assigned batch, for what the batch operators cannot say."""
    return df.groupBy(*batch).applyInPandas(fn, schema)
