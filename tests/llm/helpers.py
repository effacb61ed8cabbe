"""Small document tables for the tests of the corpus operators."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns that operators use by themselves.
CLASHING = ("key", "row", "hashes", "node", "n_words", "range", "spans", "tree", "host", "kept")


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def table(spark, texts, ids=None, source="s"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(df):
    for name in CLASHING:
        df = df.withColumn(name, df["lang"])
    return df


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
