"""Computing a value once per row before an expression uses it for every array element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    The optimizer may move a column's definition into a lambda that refers to it, where it would be
    computed again for each element. A lambda argument stays a plain value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
