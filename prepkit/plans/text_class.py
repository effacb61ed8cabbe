"""Text classification data: one label per text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.config import TextClassJob
from prepkit.operators.batches import pad_to_longest
from prepkit.operators.checks import keep_complete, require_columns
from prepkit.operators.labels import build_label_vocab, encode_label
from prepkit.operators.splits import TRAIN
from prepkit.operators.tokens import encode
from prepkit.plans.common import batch_rows, encoder_spec, first_rows, sized, token_vocab
from prepkit.session import spread


def text_class_batches(
    df: DataFrame, job: TextClassJob, labels: DataFrame | None = None, vocab: DataFrame | None = None
) -> DataFrame:
    """Padded batches ``input_ids, attention_mask, labels`` from a table with a ``split`` column.

    Labels are numbered from the train rows that are used.
    """
    job = sized(df, job)
    key, text, label = job.columns()
    df = require_columns(df, {key: None, text: T.StringType, label: None})
    rows = keep_complete(first_rows(df.select("split", key, text, label), job), [text, label])
    rows = spread(rows, [key])
    if labels is None:
        labels = build_label_vocab(rows, label, split=TRAIN)
    if vocab is None:
        vocab = token_vocab(rows, [text], job)
    spec = encoder_spec(job, job.max_length)
    coded = encode(encode_label(rows, labels, label, "labels", job.on_unknown_label), text, spec, vocab)
    features = coded.select("split", key, "input_ids", F.col("labels"))
    return pad_to_longest(batch_rows(features, job), "input_ids", spec.padding)
