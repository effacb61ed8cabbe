"""From raw documents to packed token ids: five stages, each a table of what the one before kept.

Quality rules drop documents, the Jaccard join leaves one of each class, benchmark passages and personal
data are taken out of the texts, and the rest is packed. All stages but the last return the columns of
``documents``. ``run`` stores each stage in the shared folder and reads it again, so that a lost executor
costs no more than a part of one stage.

Defined cases: an empty table gives no rows; a null, empty or very short text is rejected by the quality rules;
texts of any length are handled whole; equal texts under different ids are one class, of which the smallest id
stays, and rows equal in id and text stay once; a null id is the smallest; a host or an item may be null; other
columns go through all stages but the last, whatever their names (but ``_kept``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import decontaminate, host_quality, jaccard_join, packing, pii
from prepkit.session import pin

WORD = r"[^\x20\x09-\x0D]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-aware rules keep."""
    return host_quality.keep_good(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document of the smallest id."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; one of which nothing is left goes."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = decontaminate.remove_leaks(docs, items).where(F.col("text").rlike(WORD))
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.mask_personal(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of binary length."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", one_of_each_class),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Merges, classifiers and digests of token ids are beyond SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
