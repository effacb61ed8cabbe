"""Steps the five tasks share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.config import Job
from prepkit.operators.batches import assign_batches
from prepkit.operators.checks import require_columns
from prepkit.operators.positions import shard_count
from prepkit.operators.splits import TRAIN, VALIDATION, head_per_split, split_exact
from prepkit.operators.tokens import EncoderSpec, build_vocab, json_spec, read_tokenizer, subword_vocab
from prepkit.session import pin
from prepkit.sources.scan import scan_slice, union_splits


def load_splits(spark: SparkSession, job: Job) -> DataFrame:
    """The wanted splits as one table, checked and cut to the columns the job reads.

    A validation part is cut off train when validation is wanted but no split is named for it.
    """
    wanted = {}
    if job.do_train or (job.do_eval and not job.eval_split_name):
        wanted[TRAIN] = job.train_split_name
    if job.do_eval and job.eval_split_name:
        wanted[VALIDATION] = job.eval_split_name
    columns = job.inputs()
    read = {}
    for name, stored in wanted.items():
        df = scan_slice(
            spark, job.dataset_name, stored, job.key_column_name, job.dataset_config_name, job.dataset_format,
            job.dataset_schema, **job.dataset_options,
        )
        read[name] = require_columns(df, columns).select(*dict.fromkeys(columns))
    merged = union_splits(read)
    if job.do_eval and not job.eval_split_name:
        merged = cut_validation(merged.drop("split"), job)
        if not job.do_train:
            merged = merged.where(F.col("split") == VALIDATION)
    return merged


def cut_validation(df: DataFrame, job: Job) -> DataFrame:
    return split_exact(df, job.key_column_name, job.validation_fraction, job.seed)


def first_rows(df: DataFrame, job: Job) -> DataFrame:
    return head_per_split(df, job.key_column_name, job.limits())


def encoder_spec(job: Job, max_length: int | None) -> EncoderSpec:
    """The encoder of a job: special tokens are on by default for a given tokenizer only."""
    if job.encoder != "json":
        return EncoderSpec(
            kind=job.encoder, max_length=max_length, specials=bool(job.add_special_tokens), width=job.encoder_width
        )
    if not job.tokenizer_name:
        raise ValueError("the json encoder needs tokenizer_name, the path of a tokenizer file or folder")
    read = read_tokenizer(job.tokenizer_name)
    return json_spec(
        read["asset"],
        max_length,
        job.add_special_tokens is not False,
        job.pad_token or read["pad_token"],
        job.eos_token or read["end_token"],
    )


def token_vocab(df: DataFrame, columns: Sequence[str], job: Job) -> DataFrame | None:
    """The commonest tokens of the train split over ``columns``, computed once."""
    if job.encoder == "json":
        return None
    train = df.where(F.col("split") == TRAIN)
    one = train.select(F.col(columns[0]).alias("text"))
    for name in columns[1:]:
        one = one.unionByName(train.select(F.col(name).alias("text")))
    if job.encoder == "subword":
        return pin(subword_vocab(one, "text", job.vocab_size, job.encoder_width))
    return pin(build_vocab(one, "text", job.vocab_size, job.encoder_width))


def sized(df: DataFrame, job: Job) -> Job:
    """The job with as many shards as the rows of its input ask for; stored rows are counted, not computed ones."""
    if job.shards is not None or job.rows_per_shard is None:
        return job
    return replace(job, shards=shard_count(df, job.rows_per_shard))


def batch_size(job: Job) -> int | Column:
    size = job.per_device_train_batch_size
    if job.per_device_eval_batch_size == size:
        return size
    return F.when(F.col("split") == VALIDATION, job.per_device_eval_batch_size).otherwise(size)


def batch_rows(df: DataFrame, job: Job) -> DataFrame:
    """Batches of the size set for each split, in the order of the job's seed."""
    return assign_batches(df, job.key_column_name, batch_size(job), "split", job.shards, job.seed)
