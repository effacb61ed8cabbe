"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def small_parts(batch: pa.Array, limit: int) -> Iterator[pa.Array]:
    """``batch`` cut into runs of whole rows, each of at most ``limit`` bytes or a single row."""
    if len(batch) > 1 and batch.nbytes > limit:
        half = len(batch) // 2
        yield from small_parts(batch.slice(0, half), limit)
        yield from small_parts(batch.slice(half), limit)
    elif len(batch):
        yield batch
