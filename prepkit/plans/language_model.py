"""Language-model data: causal (text) and seq2seq (source, target)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.config import LanguageModelJob
from prepkit.operators.batches import labels_copy, labels_pad_separately, pad_to_longest
from prepkit.operators.checks import keep_complete, require_columns
from prepkit.operators.tokens import EncoderSpec, encode, encode_pair, token_length
from prepkit.plans.common import batch_rows, encoder_spec, first_rows, sized, token_vocab
from prepkit.session import spread


def text_columns(job: LanguageModelJob) -> list[str]:
    return list(dict.fromkeys(job.columns()[1:]))


def lm_spec(job: LanguageModelJob) -> EncoderSpec:
    return encoder_spec(job, int(job.max_tokens_length))


def lm_rows(df: DataFrame, job: LanguageModelJob) -> DataFrame:
    """Checked rows of each split: first N, complete, lowercased if asked."""
    texts = text_columns(job)
    df = require_columns(df, {t: T.StringType for t in texts} | {job.key_column_name: None})
    df = spread(keep_complete(first_rows(df, job), texts).select("split", job.key_column_name, *texts), [job.key_column_name])
    if job.do_lower_case:
        df = df.withColumns({t: F.lower(t) for t in texts})
    return df


def lm_features(df: DataFrame, job: LanguageModelJob, vocab: DataFrame | None = None) -> DataFrame:
    """Encoded rows ``split, key, input_ids, [labels], tokens_input_length``; inputs are dropped."""
    rows = lm_rows(df, job)
    texts, key = text_columns(job), job.key_column_name
    if vocab is None:
        vocab = token_vocab(rows, texts, job)
    spec = lm_spec(job)
    if job.model_type == "causal-lm":
        coded = encode(rows, texts[0], spec, vocab)
        return token_length(coded).select("split", key, "input_ids", "tokens_input_length")
    coded = encode_pair(rows, texts[0], texts[-1], spec, vocab)
    return token_length(coded).select("split", key, "input_ids", "labels", "tokens_input_length")


def lm_batches(df: DataFrame, job: LanguageModelJob, vocab: DataFrame | None = None) -> DataFrame:
    """Padded batches; causal labels copy the ids, seq2seq labels are padded on their own."""
    job = sized(df, job)
    pad = lm_spec(job).padding
    rows = batch_rows(lm_features(df, job, vocab), job)
    if job.model_type == "causal-lm":
        return labels_copy(pad_to_longest(rows, "input_ids", pad), mask_padding=job.mask_padding)
    return labels_pad_separately(pad_to_longest(rows, "input_ids", pad), "labels", pad)
