"""Reading named splits, holding them together, and names declared in a schema."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.operators.selection import rows_between
from prepkit.session import file_exists

WHOLE = "train"


def scan_split(
    spark: SparkSession,
    path: str,
    split: str | None = None,
    subset: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """One split of a dataset folder.

    With ``split=`` folders the filter prunes them; otherwise the split is a plain subfolder, or rows
    with its name in a ``split`` column. A dataset without any of these is all train. The format
    ``image`` reads picture files, JPEG among them, on the JVM, as columns ``image, origin, folder``.
    """
    root = "/".join([path.rstrip("/"), subset]) if subset else path
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)

    def load(place: str) -> DataFrame:
        df = reader.load(place)
        if fmt != "image":
            return df
        # Files of a folder of images: where each lies, and the folder it lies in.
        folder = F.element_at(F.split("image.origin", "/"), -2)
        return df.withColumns({"origin": F.col("image.origin"), "folder": folder})

    if split is None:
        return load(root)
    if file_exists(spark, f"{root}/split={split}"):
        return load(root).where(F.col("split") == split)
    if file_exists(spark, f"{root}/{split}"):
        return load(f"{root}/{split}").withColumn("split", F.lit(split))
    df = load(root)
    if "split" in df.columns:
        return df.where(F.col("split") == split)
    if split == WHOLE:
        return df.withColumn("split", F.lit(split))
    raise ValueError(f"no split {split!r} under {root}")


# name, name[begin:end], begin and end in rows or per cent, negative ones from the end; joined by +.
_SLICE = re.compile(r"\s*([^\[\]+]+?)\s*(?:\[\s*(-?\d+\s*%?)?\s*:\s*(-?\d+\s*%?)?\s*\])?\s*")


def _edge(text: str | None, rows: int, default: int) -> int:
    """A row number from an edge in rows or per cent, inside the table."""
    if text is None:
        return default
    number = int(text.rstrip("% "))
    at = round(number * rows / 100) if text.endswith("%") else number
    return min(max(at + rows if number < 0 else at, 0), rows)


def scan_slice(
    spark: SparkSession, path: str, split: str | None, key: str | Sequence[str], *args, **options
) -> DataFrame:
    """Parts of splits: ``train``, ``train[:10%]``, ``train[100:200]``, ``train[-5%:]+validation``.

    Rows are counted in key order; per cents are rounded to the nearest row. Other arguments are those of
    ``scan_split``.
    """
    if split is None:
        return scan_split(spark, path, None, *args, **options)
    merged = None
    for text in split.split("+"):
        found = _SLICE.fullmatch(text)
        if not found:
            raise ValueError(f"no split or slice: {text!r} in {split!r}")
        name, begin, end = found.groups()
        part = scan_split(spark, path, name, *args, **options)
        if begin is not None or end is not None:
            rows = part.count()
            start, stop = _edge(begin, rows, 0), _edge(end, rows, rows)
            part = rows_between(part, key, start, None if stop == rows and start < rows else stop)
        merged = part if merged is None else merged.unionByName(part)
    return merged


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """All splits as one table with a ``split`` column, so one plan serves them all."""
    merged = None
    for name, df in splits.items():
        part = df.withColumn("split", F.lit(name))
        merged = part if merged is None else merged.unionByName(part)
    if merged is None:
        raise ValueError("no splits given")
    return merged


def declare_labels(df: DataFrame, col: str, listed: list[str]) -> DataFrame:
    """Attach class names to a label column; they are kept in stored Parquet."""
    return df.withMetadata(col, {"names": listed})


def declared_labels(df: DataFrame, col: str) -> list[str] | None:
    """Class names declared for a label column, or for the elements of an array of labels.

    Columns made by Spark's own label indexers carry their names as well.
    """
    metadata = df.schema[col].metadata
    listed = metadata.get("names") or metadata.get("ml_attr", {}).get("vals")
    return list(listed) if listed else None


def label_element_type(df: DataFrame, col: str) -> T.DataType:
    """Type of one label: the element type if the column holds arrays."""
    dtype = df.schema[col].dataType
    return dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
