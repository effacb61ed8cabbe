"""Token classification data: one label per word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.config import TokenClassJob
from prepkit.operators.batches import labels_pad_to_input, pad_to_longest
from prepkit.operators.checks import keep_complete, require_columns
from prepkit.operators.labels import encode_label_array, label_vocab
from prepkit.operators.tokens import align_labels, encode
from prepkit.plans.common import batch_rows, encoder_spec, first_rows, sized, token_vocab
from prepkit.session import spread


def token_class_features(
    df: DataFrame, job: TokenClassJob, labels: DataFrame | None = None, vocab: DataFrame | None = None
) -> DataFrame:
    """Encoded rows ``split, key, input_ids, labels`` with word labels moved to their first pieces.

    The label vocabulary covers all splits, before the first N rows are taken.
    """
    key, text, label = job.columns()
    df = require_columns(df, {key: None, text: T.ArrayType, label: T.ArrayType})
    if labels is None:
        labels = label_vocab(df, label)
    rows = keep_complete(first_rows(df.select("split", key, text, label), job), [text, label])
    rows = spread(rows, [key])
    if vocab is None:
        vocab = token_vocab(rows, [text], job)
    spec = encoder_spec(job, job.max_length)
    coded = encode(rows, text, spec, vocab, word_ids="word_ids")
    # Labels of words past the cut are never looked up.
    used = F.slice(label, 1, F.coalesce(F.array_max("word_ids") + 1, F.lit(0)))
    coded = encode_label_array(coded.withColumn(label, used), labels, label, "label_ids", job.on_unknown_label)
    return align_labels(coded).select("split", key, "input_ids", "labels")


def token_class_batches(
    df: DataFrame, job: TokenClassJob, labels: DataFrame | None = None, vocab: DataFrame | None = None
) -> DataFrame:
    """Padded batches; labels are cut or padded with -100 to the padded ids."""
    job = sized(df, job)
    pad = encoder_spec(job, job.max_length).padding
    rows = batch_rows(token_class_features(df, job, labels, vocab), job)
    return labels_pad_to_input(pad_to_longest(rows, "input_ids", pad))
