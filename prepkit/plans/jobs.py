"""A whole job: load the splits, prepare them, store batches, vocabularies and rejected rows."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.config import CaptionJob, ImageClassJob, Job, LanguageModelJob, TextClassJob, TokenClassJob
from prepkit.functions.text import to_text
from prepkit.operators.checks import keep_complete, split_rejects
from prepkit.operators.labels import build_label_vocab, encode_label, encode_label_array, label_vocab
from prepkit.operators.scoring import apply_trained_head, evaluate_timed, train_head
from prepkit.operators.splits import TRAIN, VALIDATION
from prepkit.operators.tokens import FIRST_ID, read_tokenizer, with_specials
from prepkit.plans.common import first_rows, load_splits, token_vocab
from prepkit.plans.images import (
    caption_batches,
    caption_rows,
    image_class_batches,
    image_class_rows,
    pixel_spec,
)
from prepkit.plans.language_model import lm_batches, lm_rows, text_columns
from prepkit.plans.text_class import text_class_batches
from prepkit.plans.token_class import token_class_batches
from prepkit.session import pin, temporary_tables
from prepkit.sinks.store import (
    prepared_cache,
    write_assets,
    write_label_vocab,
    write_metrics,
    write_prepared,
)


def label_table(rows: DataFrame, job: Job) -> DataFrame | None:
    """The label vocabulary of the job, given or stored; None for tasks without labels."""
    if job.label_vocab_path:
        return rows.sparkSession.read.parquet(job.label_vocab_path)
    if isinstance(job, TokenClassJob | ImageClassJob):
        return pin(label_vocab(rows, job.label_column_name))
    if isinstance(job, TextClassJob):
        used = keep_complete(first_rows(rows, job), job.columns()[1:])
        return pin(build_label_vocab(used, job.label_column_name, split=TRAIN))
    return None


def token_table(rows: DataFrame, job: Job) -> DataFrame | None:
    """The token vocabulary of the job, given or stored; None for image classes and given tokenizers."""
    if job.token_vocab_path:
        return rows.sparkSession.read.parquet(job.token_vocab_path).where(F.col("id") >= FIRST_ID)
    if isinstance(job, LanguageModelJob):
        return token_vocab(lm_rows(rows, job), text_columns(job), job)
    if isinstance(job, TextClassJob):
        used = keep_complete(first_rows(rows, job), job.columns()[1:])
        return token_vocab(used, [job.text_column_name], job)
    if isinstance(job, CaptionJob):
        text = job.text_column_name
        shown = to_text(F.col(text), rows.schema[text].dataType, job.caption_mode)
        printed = first_rows(rows, job).withColumn("caption", shown)
        return token_vocab(printed, ["caption"], job)
    return None


def build_batches(
    rows: DataFrame,
    job: Job,
    labels: DataFrame | None = None,
    vocab: DataFrame | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Padded batches of any job from a table with a ``split`` column; ``loaded`` are its ``loaded_rows``."""
    if isinstance(job, LanguageModelJob):
        return lm_batches(rows, job, vocab)
    if isinstance(job, TokenClassJob):
        return token_class_batches(rows, job, labels, vocab)
    if isinstance(job, TextClassJob):
        return text_class_batches(rows, job, labels, vocab)
    if isinstance(job, ImageClassJob):
        return image_class_batches(rows, job, labels, loaded)
    if isinstance(job, CaptionJob):
        return caption_batches(rows, job, vocab, loaded)
    raise ValueError(f"no task for {type(job).__name__}")


def loaded_rows(rows: DataFrame, job: Job) -> DataFrame | None:
    """The rows of an image job with their images, fetched once for batches and rejects; else None."""
    if isinstance(job, ImageClassJob):
        return image_class_rows(rows, job)
    if isinstance(job, CaptionJob):
        return caption_rows(rows, job)
    return None


def rejected_rows(
    rows: DataFrame, job: Job, labels: DataFrame | None = None, loaded: DataFrame | None = None
) -> DataFrame:
    """``split, key, error`` of the rows the batches leave out."""
    key = job.key_column_name
    if isinstance(job, ImageClassJob | CaptionJob):
        loaded = loaded_rows(rows, job) if loaded is None else loaded
        return loaded.where(F.col("error").isNotNull()).select("split", key, "error")
    rows = first_rows(rows, job)
    inputs = job.columns()[1:]
    complete, missing = split_rejects(rows, inputs)
    named = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in inputs])
    out = missing.select("split", key, F.concat(F.lit("missing: "), named).alias("error"))
    if isinstance(job, TextClassJob) and job.on_unknown_label == "drop" and labels is not None:
        unknown = _unknown_labels(complete, job, labels)
        out = out.unionByName(unknown.select("split", key, F.lit("label not in vocabulary").alias("error")))
    return out


def _unknown_labels(rows: DataFrame, job: TextClassJob, labels: DataFrame) -> DataFrame:
    if isinstance(job, TokenClassJob):
        coded = encode_label_array(rows, labels, job.label_column_name, "__ids", on_unknown="keep_null")
        return coded.where(F.exists("__ids", lambda v: v.isNull()))
    return encode_label(rows, labels, job.label_column_name, "__id", "keep_null").where(F.col("__id").isNull())


def head_metrics(rows: DataFrame, job: TextClassJob, labels: DataFrame) -> DataFrame:
    """Loss, samples and times of a head fitted on the vectors of train rows and scored on validation rows."""
    vector, label = job.vector_column_name, job.label_column_name
    used = keep_complete(first_rows(rows, job), [vector, label])
    coded = pin(encode_label(used.select("split", vector, label), labels, label, "__coded", "keep_null"), "vectors")
    train = coded.where((F.col("split") == TRAIN) & F.col("__coded").isNotNull())
    model = train_head(train, vector, "__coded", labels.count(), job.head_steps, job.seed)
    scored = apply_trained_head(coded.where(F.col("split") == VALIDATION), model, vector)
    return evaluate_timed(scored, "logits", "__coded", run="head")


def run_job(spark: SparkSession, job: Job) -> DataFrame:
    """Store everything under ``output_dir``; returns rows per stored file of each split.

    With ``cache_dir`` the finished tables for the same shaping settings and input files are used again,
    before anything is computed, unless ``overwrite_cache`` is set. A text-class job with
    ``vector_column_name`` also fits a head on those vectors and stores its validation metrics.
    """
    if not job.output_dir:
        raise ValueError("output_dir is not set")
    with temporary_tables(spark):
        return _run(spark, job, job.output_dir.rstrip("/"))


def _parts(spark: SparkSession, job: Job) -> dict[str, DataFrame]:
    """The tables of a job by name."""
    rows = load_splits(spark, job)
    labels, vocab, loaded = label_table(rows, job), token_table(rows, job), loaded_rows(rows, job)
    parts = {
        "batches": build_batches(rows, job, labels, vocab, loaded),
        "rejects": rejected_rows(rows, job, labels, loaded),
        "labels": labels,
        "tokens": None if vocab is None else with_specials(vocab),
    }
    return {name: df for name, df in parts.items() if df is not None}


def _run(spark: SparkSession, job: Job, out: str) -> DataFrame:
    made = cache(lambda: _parts(spark, job))
    if job.cache_dir:
        found = {}
        for name in part_names(job):
            settings = job.shaping() | {"part": name, "tokenizer": tokenizer_digest(job)}
            found[name], _ = prepared_cache(
                spark, job.cache_dir, settings, input_paths(job), lambda n=name: made()[n], job.overwrite_cache
            )
    else:
        found = made()
    report = write_prepared(found["batches"], f"{out}/batches")
    found["rejects"].write.mode("overwrite").parquet(f"{out}/rejects")
    if "labels" in found:
        write_label_vocab(found["labels"], f"{out}/labels")
    if "tokens" in found:
        found["tokens"].coalesce(1).write.mode("overwrite").parquet(f"{out}/tokens")
    if isinstance(job, TextClassJob) and job.vector_column_name:
        write_metrics(head_metrics(load_splits(spark, job), job, found["labels"]), f"{out}/metrics")
    assets = {"job.json": asdict(job)}
    if isinstance(job, ImageClassJob | CaptionJob):
        assets["pixels.json"] = pixel_spec(job).settings()
    write_assets(spark, out, assets)
    return report


def part_names(job: Job) -> list[str]:
    """The tables a job makes; batches last, so that what is found whole was finished whole."""
    labels = isinstance(job, TextClassJob | ImageClassJob)
    tokens = not isinstance(job, ImageClassJob | TokenClassJob) and (job.encoder != "json" or job.token_vocab_path)
    return ["rejects", *(["labels"] if labels else []), *(["tokens"] if tokens else []), "batches"]


def input_paths(job: Job) -> list[str]:
    """Everything a job reads whose change asks for new tables."""
    return [p for p in (job.dataset_name, job.label_vocab_path, job.token_vocab_path) if p]


def tokenizer_digest(job: Job) -> str | None:
    """A digest of what the tokenizer files say."""
    if not job.tokenizer_name:
        return None
    return hashlib.sha256(json.dumps(read_tokenizer(job.tokenizer_name), sort_keys=True).encode()).hexdigest()
