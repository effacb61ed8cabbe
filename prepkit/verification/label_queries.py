"""Label vocabularies, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.text import words
from prepkit.operators import labels as ops
from prepkit.session import pin, spread
from prepkit.verification.registry import (
    WORDS,
    query,
    sql_exact_split,
    sql_hash_split,
    sql_text,
    table,
    text_of,
)
from prepkit.verification.table_queries import declared_embeddings, split_documents


def word_tag(word: Column) -> Column:
    """Tag of a word: NUM, END, CAP or O."""
    return (
        F.when(F.translate(word, "0123456789", "") != word, F.lit("NUM"))
        .when(F.substring(word, -1, 1).isin(".", ",", "!", "?"), F.lit("END"))
        .when(F.lower(word) != word, F.lit("CAP"))
        .otherwise(F.lit("O"))
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as words with one tag per word."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    listed = docs.select("doc_id", words("text").alias("tokens"))
    return listed.withColumn("ner_tags", F.transform("tokens", word_tag))


SQL_TAG = """case when regexp_matches(v, '[0-9]') then 'NUM' when regexp_matches(v, '[.,!?]$') then 'END'
    when lower(v) <> v then 'CAP' else 'O' end"""
SQL_TAGGED = f"""select doc_id, tokens, list_transform(tokens, lambda v: {SQL_TAG}) as ner_tags from
    (select doc_id, regexp_extract_all(text, {WORDS}) as tokens from documents)"""
SQL_TAG_IDS = """select label, row_number() over (order by label) - 1 as id from
    (select distinct unnest(ner_tags) as label from t)"""


def sql_label_vocab(source: str, label: str, where: str = "true") -> str:
    return (
        f"select {label} as label, row_number() over (order by {label}) - 1 as id from "
        f"(select distinct {label} from {source} where {where} and {label} is not null)"
    )


def with_long_id(vocab: DataFrame) -> DataFrame:
    return vocab.select("label", F.col("id").cast("bigint"))


@query(
    """select vec_id, 'class ' || chr(106 - label) as label_name, cast(label as bigint) as id from embeddings"""
)
def vocab_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = declared_embeddings(spark, sf_dir)
    vocab = ops.declared_vocab(stored, "label")
    named = ops.decode_label(stored, vocab, "label", "label_name")
    return named.select("vec_id", "label_name", F.col("label").cast("bigint").alias("id"))


@query(sql_label_vocab("documents", "lang"))
def vocab_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_long_id(ops.build_label_vocab(split_documents(spark, sf_dir), "lang"))


@query(sql_label_vocab("labels", "quality"), name="vocab_scalar_int")
def vocab_of_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_long_id(ops.build_label_vocab(table(spark, sf_dir, "labels"), "quality"))


@query(f"with t as ({SQL_TAGGED}) {SQL_TAG_IDS}")
def vocab_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_long_id(ops.build_label_vocab(tagged(spark, sf_dir), "ner_tags"))


@query(
    f"""with d as ({sql_hash_split('documents', 'doc_id')})
    {sql_label_vocab('d', 'source', "split = 'train'")}"""
)
def vocab_train_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = split_documents(spark, sf_dir).select("doc_id", "split", "source")
    return with_long_id(ops.build_label_vocab(docs, "source", split="train"))


@query("select count(distinct lang) as num_labels from documents")
def num_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.num_labels(ops.build_label_vocab(table(spark, sf_dir, "documents"), "lang"))


@query(
    f"""with d as ({sql_exact_split('documents', 'doc_id')}), v as ({sql_label_vocab('d', 'lang', "split = 'train'")})
    select doc_id, split, lang, v.id as label_id from d join v on v.label = d.lang"""
)
def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepkit.operators.splits import split_exact

    docs = split_exact(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    vocab = ops.build_label_vocab(docs, "lang", split="train")
    coded = ops.encode_label(docs, vocab, "lang")
    return coded.select("doc_id", "split", "lang", F.col("label_id").cast("bigint"))


@query(
    f"""with v as ({sql_label_vocab('documents', 'lang', "lang <> 'fr'")})
    select doc_id, v.id as kept_id, lang, 'keep_null' as policy from documents left join v on v.label = lang
    union all select doc_id, v.id, lang, 'drop' from documents join v on v.label = lang"""
)
def encode_label_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    vocab = ops.build_label_vocab(docs.where("lang <> 'fr'"), "lang")
    parts = [
        ops.encode_label(docs, vocab, "lang", on_unknown=policy).withColumn("policy", F.lit(policy))
        for policy in ("keep_null", "drop")
    ]
    return parts[0].unionByName(parts[1]).select(
        "doc_id", F.col("label_id").cast("bigint").alias("kept_id"), "lang", "policy"
    )


@query(
    f"""with v as ({sql_label_vocab('documents', 'source')})
    select 'declared' as kind, vec_id as row_id, cast(label as bigint) as label_id from embeddings
    union all select 'found', doc_id, v.id from documents join v on v.label = source
    union all select 'raw', doc_id, cast(quality as bigint) from labels"""
)
def encode_label_or_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "source")
    sources = pin(ops.build_label_vocab(docs, "source"))
    stored = declared_embeddings(spark, sf_dir).select(F.col("vec_id").alias("row_id"), "label")
    grades = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), "quality")
    parts = [
        ("declared", ops.encode_label_or_raw(stored, ops.declared_vocab(stored, "label"), "label")),
        ("found", ops.encode_label_or_raw(docs, sources, "source")),
        ("raw", ops.encode_label_or_raw(grades, sources, "quality")),
    ]
    shown = [
        df.select(F.lit(kind).alias("kind"), "row_id", F.col("label_id").cast("bigint")) for kind, df in parts
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("select doc_id, source as label_name from documents")
def decode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    vocab = pin(ops.build_label_vocab(docs, "source"))
    coded = ops.encode_label(docs, vocab, "source").select("doc_id", "label_id")
    return ops.decode_label(coded, vocab, "label_id").select("doc_id", "label_name")


@query(
    f"""with t as ({SQL_TAGGED}), v as ({SQL_TAG_IDS}), m as (select map(list(label), list(id)) as m from v)
    select doc_id, {sql_text('list_transform(ner_tags, lambda x: m.m[x])')} as label_ids from t, m"""
)
def encode_label_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pin(tagged(spark, sf_dir))
    vocab = ops.label_vocab(docs, "ner_tags")
    coded = ops.encode_label_array(docs, vocab, "ner_tags")
    return coded.select("doc_id", text_of("label_ids").alias("label_ids"))
