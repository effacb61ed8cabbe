"""Label vocabularies: building them, and turning labels into ids and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.lookup import map_array
from prepkit.operators.positions import global_position
from prepkit.session import is_small, pin, small_side
from prepkit.sources.scan import declared_labels

UNKNOWN_POLICIES = ("error", "drop", "keep_null")


def distinct_labels(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null labels of a scalar column, or of the elements of an array column."""
    listed = isinstance(df.schema[col].dataType, T.ArrayType)
    value = F.explode(col) if listed else F.col(col)
    return df.select(value.alias("label")).where(F.col("label").isNotNull()).distinct()


def build_label_vocab(df: DataFrame, col: str, split: str | None = None) -> DataFrame:
    """Table ``(label, id)``: labels sorted, numbered from 0; of one split only if ``split`` is given."""
    if split is not None:
        df = df.where(F.col("split") == split)
    found = pin(distinct_labels(df, col))
    if is_small(found):
        rank = F.row_number().over(W.orderBy("label"))
        return found.select("label", (rank - 1).cast("int").alias("id"))
    placed = global_position(found, "label")
    return placed.select("label", (F.col("position") - 1).cast("int").alias("id"))


def declared_vocab(df: DataFrame, col: str) -> DataFrame | None:
    """Table ``(label, id)`` from the names declared in the schema, in declared order."""
    listed = declared_labels(df, col)
    if listed is None:
        return None
    rows = [(name, i) for i, name in enumerate(listed)]
    return df.sparkSession.createDataFrame(rows, "label string, id int")


def label_vocab(df: DataFrame, col: str, split: str | None = None) -> DataFrame:
    """Declared names if the schema has them, else the labels found in the data."""
    declared = declared_vocab(df, col)
    return build_label_vocab(df, col, split) if declared is None else declared


def num_labels(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).alias("num_labels"))


def known_or_error(value: Column, label: Column) -> Column:
    """``value``, or a failed job naming the label where it is missing."""
    message = F.concat(F.lit("label not in vocabulary: "), F.coalesce(label.cast("string"), F.lit("null")))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(message).cast("int"))


def encode_label(
    df: DataFrame, vocab: DataFrame, col: str, out: str = "label_id", on_unknown: str = "error"
) -> DataFrame:
    """Add the id of each label; labels outside the vocabulary fail, are dropped, or become null."""
    if on_unknown not in UNKNOWN_POLICIES:
        raise ValueError(f"on_unknown must be one of {', '.join(UNKNOWN_POLICIES)}")
    side = small_side(vocab.select(F.col("label").alias("__label"), F.col("id").alias("__id")))
    how = "inner" if on_unknown == "drop" else "left"
    coded = df.join(side, F.col(col) == F.col("__label"), how)
    value = F.col("__id")
    if on_unknown == "error":
        value = known_or_error(value, F.col(col))
    return coded.withColumn(out, value).drop("__label", "__id")


def encode_label_or_raw(df: DataFrame, vocab: DataFrame, col: str, out: str = "label_id") -> DataFrame:
    """Add label ids; a column that already holds ids keeps them.

    Decided for the whole column: with declared names an integer column holds ids. Otherwise a
    label outside the vocabulary is used as it is, if it is a number.
    """
    if declared_labels(df, col) is not None and isinstance(df.schema[col].dataType, T.NumericType):
        return df.withColumn(out, F.col(col).cast("int"))
    vocab = vocab.withColumn("label", F.col("label").cast("string"))
    side = small_side(vocab.select(F.col("label").alias("__label"), F.col("id").alias("__id")))
    raw = F.col(col).try_cast("int")
    return (
        df.join(side, F.col(col).cast("string") == F.col("__label"), "left")
        .withColumn(out, F.coalesce(F.col("__id"), raw))
        .drop("__label", "__id")
    )


def decode_label(df: DataFrame, vocab: DataFrame, col: str, out: str = "label_name") -> DataFrame:
    """Add the label of each id; null for ids outside the vocabulary."""
    side = small_side(vocab.select(F.col("label").alias(out), F.col("id").alias("__id")))
    return df.join(side, F.col(col) == F.col("__id"), "left").drop("__id")


def encode_label_array(
    df: DataFrame,
    vocab: DataFrame,
    col: str,
    out: str = "label_ids",
    on_unknown: str = "error",
) -> DataFrame:
    """Add the ids of an array of labels; integer arrays with declared names are ids already."""
    dtype = df.schema[col].dataType
    if declared_labels(df, col) is not None and isinstance(dtype.elementType, T.IntegralType):
        return df.withColumn(out, F.col(col).cast("array<int>"))
    coded = map_array(df, col, vocab, "label", "id", "__ids")
    value = F.col("__ids")
    if on_unknown == "error":
        value = F.zip_with("__ids", col, known_or_error)
    elif on_unknown == "drop":
        coded = coded.where(~F.exists("__ids", lambda v: v.isNull()))
    return coded.withColumn(out, value).drop("__ids")
