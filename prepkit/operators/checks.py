"""Checks on columns and rows before work starts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(
    df: DataFrame, wanted: Mapping[str, type[T.DataType] | tuple | None] | Sequence[str]
) -> DataFrame:
    """Fail before any job if a column is missing or has another type; returns ``df`` for chaining."""
    types = wanted if isinstance(wanted, Mapping) else dict.fromkeys(wanted)
    for name, dtype in types.items():
        if name not in df.columns:
            raise ValueError(f"column {name!r} not found; choose one of {', '.join(df.columns)}")
        if dtype is not None and not isinstance(df.schema[name].dataType, dtype):
            raise ValueError(f"column {name!r} has type {df.schema[name].dataType.simpleString()}")
    return df


def missing_features(df: DataFrame, col: str = "input_ids", by: Sequence[str] = ()) -> DataFrame:
    """Counts of rows without ``col`` and of all rows."""
    return df.groupBy(*by).agg(
        F.count_if(F.col(col).isNull()).alias("missing"), F.count(F.lit(1)).alias("total")
    )


def require_features(df: DataFrame, col: str = "input_ids") -> DataFrame:
    """Fail, naming both counts, if any row lacks ``col``."""
    row = missing_features(df, col).first()
    if row["missing"]:
        raise ValueError(f"{row['missing']}/{row['total']} rows without {col}")
    return df


def assert_features(df: DataFrame, col: str = "input_ids") -> DataFrame:
    """The same check inside the plan: the job that reads ``col`` fails on a missing value."""
    message = F.lit(f"row without {col}")
    dtype = df.schema[col].dataType
    return df.withColumn(
        col, F.when(F.col(col).isNotNull(), F.col(col)).otherwise(F.raise_error(message).cast(dtype))
    )


def _all_present(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in cols])


def keep_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all of ``cols`` are present; stored columns are tested in the scan."""
    return df.where(_all_present(cols))


def split_rejects(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all of ``cols`` present, and the others."""
    return df.where(_all_present(cols)), df.where(~_all_present(cols))
