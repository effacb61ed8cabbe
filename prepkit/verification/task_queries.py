"""The six tasks end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.config import CaptionJob, ImageClassJob, LanguageModelJob, TextClassJob, TokenClassJob
from prepkit.operators.splits import split_exact, split_hash
from prepkit.plans.images import caption_batches, image_class_batches
from prepkit.plans.language_model import lm_batches
from prepkit.plans.text_class import text_class_batches
from prepkit.plans.token_class import token_class_batches
from prepkit.session import pin
from prepkit.verification.image_queries import SQL_PIXELS, vector_images
from prepkit.verification.label_queries import SQL_TAG_IDS, SQL_TAGGED, sql_label_vocab, tagged
from prepkit.verification.registry import (
    ROWS_PER_SHARD,
    WORDS,
    micro_text,
    query,
    sql_batches,
    sql_encode,
    sql_exact_split,
    sql_hash_split,
    sql_micro,
    sql_pad,
    sql_shards,
    sql_text,
    sql_vocab,
    table,
    text_of,
)
from prepkit.verification.table_queries import split_documents
from prepkit.verification.token_queries import SQL_ALIGNED, SQL_MASK, SQL_PAIRS, SQL_PIECES, turn_pairs

SQL_AT = "split, cast(shard as bigint) as shard, cast(batch_id as bigint) as batch_id, cast(pos as bigint) as pos"
SQL_BATCH = "window q as (partition by split, shard, batch_id)"


def at(*more: str) -> list:
    return ["split", *(F.col(c).cast("bigint") for c in ("shard", "batch_id", "pos")), *more]


@query(
    f"""with d as ({sql_hash_split('documents', 'doc_id')}),
    w as (select doc_id, split, regexp_extract_all(lower(text), {WORDS}) as w from d),
    v as ({sql_vocab("(select * from w where split = 'train')", 10000)}),
    e as ({sql_encode('w', 'doc_id', 'v', 's.split,')}), r as (select doc_id, split, ids[1:128] as ids from e),
    b as ({sql_batches('r', 'doc_id', 2, sql_shards('r'))}), x as (select *, max(len(ids)) over q as m from b {SQL_BATCH})
    select {SQL_AT}, doc_id, {sql_text(sql_pad('ids', 'm', '0'))} as input_ids, {sql_text(SQL_MASK)} as attention_mask,
    {sql_text(sql_pad('ids', 'm', '0'))} as labels, len(ids) as tokens_input_length from x"""
)
def lm_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = LanguageModelJob(
        key_column_name="doc_id", text_column_name="text", max_tokens_length=128, do_lower_case=True,
        per_device_train_batch_size=2, per_device_eval_batch_size=2, rows_per_shard=ROWS_PER_SHARD, vocab_size=10_000,
    )
    rows = lm_batches(split_documents(spark, sf_dir), job)
    return rows.select(
        *at("doc_id"),
        text_of("input_ids").alias("input_ids"),
        text_of("attention_mask").alias("attention_mask"),
        text_of("labels").alias("labels"),
        F.col("tokens_input_length").cast("bigint"),
    )


@query(
    f"""with c as ({SQL_PAIRS}), d as ({sql_hash_split('c', 'pair_id')}),
    s as (select pair_id, split, regexp_extract_all(source, {WORDS}) as w from d),
    g as (select pair_id, split, regexp_extract_all(target, {WORDS}) as w from d),
    v as ({sql_vocab("(select w from s where split = 'train' union all select w from g where split = 'train')", 10000)}),
    es as ({sql_encode('s', 'pair_id', 'v', 's.split,')}), eg as ({sql_encode('g', 'pair_id', 'v')}),
    r as (select pair_id, split, es.ids[1:128] as ids, eg.ids[1:128] as labels from es join eg using (pair_id)),
    b as ({sql_batches('r', 'pair_id', 2, sql_shards('r'))}),
    x as (select *, max(len(ids)) over q as m, max(len(labels)) over q as n from b {SQL_BATCH})
    select {SQL_AT}, pair_id, {sql_text(sql_pad('ids', 'm', '0'))} as input_ids, {sql_text(SQL_MASK)} as attention_mask,
    {sql_text(sql_pad('labels', 'n', '0'))} as labels, len(ids) as tokens_input_length from x"""
)
def lm_seq2seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = LanguageModelJob(
        model_type="seq2seq", key_column_name="pair_id", source_column_name="source", target_column_name="target",
        max_tokens_length=128, per_device_train_batch_size=2, per_device_eval_batch_size=2, rows_per_shard=ROWS_PER_SHARD,
        vocab_size=10_000,
    )
    rows = lm_batches(split_hash(turn_pairs(spark, sf_dir), "pair_id"), job)
    return rows.select(
        *at("pair_id"),
        text_of("input_ids").alias("input_ids"),
        text_of("attention_mask").alias("attention_mask"),
        text_of("labels").alias("labels"),
        F.col("tokens_input_length").cast("bigint"),
    )


@query(
    f"""with d as ({sql_exact_split('documents', 'doc_id')}),
    l as ({sql_label_vocab('d', 'lang', "split = 'train'")}),
    w as (select doc_id, split, l.id as labels, regexp_extract_all(text, {WORDS}) as w from d join l on l.label = lang),
    v as ({sql_vocab("(select * from w where split = 'train')", 10000)}),
    r as ({sql_encode('w', 'doc_id', 'v', 's.split, s.labels,')}),
    b as ({sql_batches('r', 'doc_id', 2, sql_shards('r'))}), x as (select *, max(len(ids)) over q as m from b {SQL_BATCH})
    select {SQL_AT}, doc_id, {sql_text(sql_pad('ids', 'm', '0'))} as input_ids, {sql_text(SQL_MASK)} as attention_mask,
    labels from x"""
)
def seqclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = TextClassJob(
        key_column_name="doc_id", text_column_name="text", label_column_name="lang", per_device_train_batch_size=2,
        per_device_eval_batch_size=2, rows_per_shard=ROWS_PER_SHARD, vocab_size=10_000,
    )
    docs = split_exact(table(spark, sf_dir, "documents"), "doc_id")
    rows = text_class_batches(docs, job)
    return rows.select(
        *at("doc_id"),
        text_of("input_ids").alias("input_ids"),
        text_of("attention_mask").alias("attention_mask"),
        F.col("labels").cast("bigint"),
    )


@query(
    f"""with t as ({SQL_TAGGED}), {SQL_PIECES}, d as ({sql_exact_split('documents', 'doc_id')}),
    s as (select doc_id, split from d),
    v as ({sql_vocab("(select w from p join s using (doc_id) where split = 'train')", 10000)}),
    e as ({sql_encode('p', 'doc_id', 'v', 's.word_ids, s.ner_tags,')}), k as ({SQL_TAG_IDS}),
    m as (select map(list(label), list(id)) as m from k),
    c as (select doc_id, split, ids[1:512] as ids, word_ids[1:512] as word_ids, ner_tags from e join s using (doc_id)),
    r as (select doc_id, split, ids, {SQL_ALIGNED} as labels from c, m),
    b as ({sql_batches('r', 'doc_id', 2, sql_shards('r'))}), x as (select *, max(len(ids)) over q as m from b {SQL_BATCH})
    select {SQL_AT}, doc_id, {sql_text(sql_pad('ids', 'm', '0'))} as input_ids, {sql_text(SQL_MASK)} as attention_mask,
    {sql_text(sql_pad('labels', 'm', '-100'))} as labels from x"""
)
def tokenclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = TokenClassJob(
        key_column_name="doc_id", text_column_name="tokens", label_column_name="ner_tags", encoder="chunk",
        encoder_width=4, per_device_train_batch_size=2, per_device_eval_batch_size=2, rows_per_shard=ROWS_PER_SHARD,
        vocab_size=10_000,
    )
    rows = token_class_batches(split_exact(pin(tagged(spark, sf_dir)), "doc_id"), job)
    return rows.select(
        *at("doc_id"),
        text_of("input_ids").alias("input_ids"),
        text_of("attention_mask").alias("attention_mask"),
        text_of("labels").alias("labels"),
    )


@query(
    f"""with {SQL_PIXELS}, d as ({sql_exact_split('embeddings', 'vec_id')}), l as ({sql_label_vocab('d', 'label')}),
    r as (select vec_id, split, l.id as labels, pixel_values, row_number() over (partition by split order by vec_id) as rn
    from d join pixels using (vec_id) join l on l.label = d.label)
    select split, cast(0 as bigint) as shard, (rn - 1) // 2 as batch_id, (rn - 1) % 2 as pos, vec_id,
    {sql_micro('pixel_values')} as pixel_values, labels from r"""
)
def imageclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = ImageClassJob(
        key_column_name="vec_id", image_column_name="url", label_column_name="label", image_height=4, image_width=4,
        per_device_train_batch_size=2, per_device_eval_batch_size=2,
    )
    rows = image_class_batches(split_exact(vector_images(spark, sf_dir), "vec_id"), job)
    return rows.select(
        *at("vec_id"), micro_text("pixel_values").alias("pixel_values"), F.col("labels").cast("bigint")
    )


SQL_CAPTION = """'[''class ' || label || ''', "it''s ' || vec_id % 7 || '", ''say "hi"'']'"""


@query(
    f"""with {SQL_PIXELS}, c as (select vec_id, {SQL_CAPTION} as caption from embeddings),
    d as ({sql_exact_split('c', 'vec_id')}), w as (select vec_id, split, regexp_extract_all(caption, {WORDS}) as w from d),
    v as ({sql_vocab("(select w from w where split = 'train')", 100)}),
    e as ({sql_encode('w', 'vec_id', 'v', 's.split,')}),
    r as (select vec_id, split, ids, pixel_values from e join pixels using (vec_id)),
    b as ({sql_batches('r', 'vec_id', 8, sql_shards('embeddings'))}), x as (select *, max(len(ids)) over q as m from b {SQL_BATCH})
    select {SQL_AT}, vec_id, {sql_text(sql_pad('ids', 'm', '0'))} as input_ids, {sql_text(SQL_MASK)} as attention_mask,
    {sql_text(sql_pad('ids', 'm', '-100'))} as labels, {sql_micro('pixel_values')} as pixel_values from x"""
)
def imagecap(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = CaptionJob(
        key_column_name="vec_id", image_column_name="content", text_column_name="tags", image_height=4, image_width=4,
        rows_per_shard=ROWS_PER_SHARD, vocab_size=100,
    )
    tags = F.array(
        F.concat(F.lit("class "), F.col("label")),
        F.concat(F.lit("it's "), F.col("vec_id") % 7),
        F.lit('say "hi"'),
    )
    rows = vector_images(spark, sf_dir).withColumn("tags", tags)
    rows = rows.withColumn("content", F.when(F.col("label") != 9, F.col("content")))
    done = caption_batches(split_exact(rows, "vec_id"), job)
    return done.select(
        *at("vec_id"),
        text_of("input_ids").alias("input_ids"),
        text_of("attention_mask").alias("attention_mask"),
        text_of("labels").alias("labels"),
        micro_text("pixel_values").alias("pixel_values"),
    )
