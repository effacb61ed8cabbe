"""Image classification and caption data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.config import CaptionJob, ImageClassJob
from prepkit.functions.text import to_text
from prepkit.operators.batches import assign_batches, labels_masked_copy, pad_to_longest
from prepkit.operators.checks import assert_features, require_columns
from prepkit.operators.labels import encode_label_or_raw, label_vocab
from prepkit.operators.pixels import PixelSpec, check_pixels, to_pixels
from prepkit.operators.tokens import encode
from prepkit.plans.common import batch_size, encoder_spec, first_rows, sized, token_vocab
from prepkit.session import pin, spread
from prepkit.sources.images import load_content


def pixel_spec(job: ImageClassJob | CaptionJob) -> PixelSpec:
    return PixelSpec(height=job.image_height, width=job.image_width)


def loaded_images(df: DataFrame, job: ImageClassJob | CaptionJob) -> DataFrame:
    """Replaces the image by ``__content`` (its bytes or struct) and ``error``, as a stored table.

    Images are fetched and tried once; what is stored and shuffled later are compressed bytes.
    """
    return pin(check_pixels(_contents(df, job, False), pixel_spec(job), "__content"), "images")


def _contents(df: DataFrame, job: ImageClassJob | CaptionJob, store_fetched: bool) -> DataFrame:
    loaded = load_content(
        spread(df, [job.key_column_name]),
        job.image_column_name,
        "__content",
        timeout_s=job.requests_timeout,
        store_fetched=store_fetched,
        partitions=job.processing_num_workers,
    )
    return loaded.drop(job.image_column_name)


def image_prepare(df: DataFrame, job: ImageClassJob | CaptionJob) -> DataFrame:
    """Fetch, decode and normalise: replaces the image by ``pixel_values``, its shape, and ``error``.

    Nothing is shuffled between, so each image is decoded once; fetched bytes are stored.
    """
    return to_pixels(_contents(df, job, True), pixel_spec(job), "__content").drop("__content")


def with_pixels(batched: DataFrame, job: ImageClassJob | CaptionJob) -> DataFrame:
    """The last step: pixel values of rows that have their batch already, so that none are shuffled."""
    return to_pixels(batched, pixel_spec(job), "__content").drop("__content", "error")


def batch_loaded(df: DataFrame, job: ImageClassJob | CaptionJob, seed: int | None) -> DataFrame:
    """Batches of rows that still hold compressed images."""
    return assign_batches(df, job.key_column_name, batch_size(job), "split", job.shards, seed)


def image_class_rows(df: DataFrame, job: ImageClassJob) -> DataFrame:
    """All rows with their image bytes, label, and an ``error`` where the image or the label is unusable."""
    key, image, label = job.columns()
    wanted = dict.fromkeys(["split", key, image, label])
    loaded = loaded_images(first_rows(df.select(*wanted), job), job)
    missing = F.when(F.col(label).isNull(), F.lit("no label"))
    return loaded.withColumn("error", F.coalesce("error", missing))


def image_class_batches(
    df: DataFrame, job: ImageClassJob, labels: DataFrame | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Batches ``pixel_values, labels`` in stored order; ``rows`` are those of ``image_class_rows``."""
    key, image, label = job.columns()
    df = require_columns(df, [key, image, label])
    job = sized(df, job)
    if labels is None:
        labels = label_vocab(df, label)
    kept = (image_class_rows(df, job) if rows is None else rows).where(F.col("error").isNull()).drop("error")
    coded = encode_label_or_raw(kept, labels, label, "labels")
    return with_pixels(batch_loaded(coded if label == "labels" else coded.drop(label), job, None), job)


def caption_rows(df: DataFrame, job: CaptionJob) -> DataFrame:
    """All rows with their image bytes, printed caption, and an ``error`` where the image is unusable."""
    key, image, text = job.columns()
    printed = to_text(F.col(text), df.schema[text].dataType, job.caption_mode)
    wanted = dict.fromkeys(["split", key, image])
    return loaded_images(first_rows(df, job).select(*wanted, printed.alias("caption")), job)


def caption_batches(
    df: DataFrame, job: CaptionJob, vocab: DataFrame | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Batches with padded caption ids, and labels that ignore the padding; ``rows`` are those of ``caption_rows``."""
    df = require_columns(df, job.columns())
    job = sized(df, job)
    spec = encoder_spec(job, job.max_length)
    rows = caption_rows(df, job) if rows is None else rows
    if vocab is None:
        vocab = token_vocab(rows, ["caption"], job)
    kept = encode(rows.where(F.col("error").isNull()).drop("error"), "caption", spec, vocab).drop("caption")
    batched = pad_to_longest(batch_loaded(assert_features(kept), job, job.seed), "input_ids", spec.padding)
    return with_pixels(labels_masked_copy(batched, "input_ids", spec.padding), job)
