"""Encoders, alignment, batches and padding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.lookup import packed_lookup
from prepkit.functions.text import words
from prepkit.operators import batches as pack
from prepkit.operators import tokens as ops
from prepkit.operators.labels import encode_label_array, label_vocab
from prepkit.operators.positions import shard_count
from prepkit.operators.tokens import EncoderSpec
from prepkit.session import pin, spread
from prepkit.verification.label_queries import SQL_TAG_IDS, SQL_TAGGED, tagged
from prepkit.verification.registry import (
    ROWS_PER_SHARD,
    WORDS,
    query,
    sql_batches,
    sql_encode,
    sql_hash_split,
    sql_pad,
    sql_repeat,
    sql_shards,
    sql_text,
    sql_vocab,
    table,
    text_of,
)
from prepkit.verification.table_queries import split_documents

VOCAB = 5000
PIECES = 2000
WIDTH = 4

SQL_WORDS = f"w as (select doc_id, regexp_extract_all(text, {WORDS}) as w from documents)"
SQL_VOCAB = f"{SQL_WORDS}, v as ({sql_vocab('w', VOCAB)})"
SQL_CODED = f"{SQL_VOCAB}, e as ({sql_encode('w', 'doc_id', 'v')})"
# Pieces of each word, and for each piece the 0-based index of its word.
SQL_PIECES = f"""p as (select doc_id, tokens, ner_tags, flatten(list_transform(tokens,
    lambda x: list_transform(range(0, (length(x) - 1) // {WIDTH} + 1),
    lambda k: substr(x, k * {WIDTH} + 1, {WIDTH})))) as w,
    flatten(list_transform(tokens, lambda x, i: list_transform(range(0, (length(x) - 1) // {WIDTH} + 1),
    lambda k: i - 1))) as word_ids from t)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def document_shards(spark: SparkSession, sf_dir: str) -> int:
    return shard_count(table(spark, sf_dir, "documents"), ROWS_PER_SHARD)


def vocab_of(docs: DataFrame) -> DataFrame:
    return pin(ops.build_vocab(docs, "text", VOCAB))


def coded_documents(spark: SparkSession, sf_dir: str, max_length: int | None = None) -> DataFrame:
    docs = spread(split_documents(spark, sf_dir).select("doc_id", "split", "text"), ["doc_id"])
    spec = EncoderSpec(max_length=max_length)
    return ops.encode(docs, "text", spec, vocab_of(docs)).select("doc_id", "split", "input_ids")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it, as an equi-join on the turn number."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("source"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target")
    )
    return asked.join(answered, ["conv_id", "turn"]).withColumn("pair_id", F.concat_ws("-", "conv_id", "turn"))


SQL_PAIRS = """select conv_id || '-' || turn as pair_id, conv_id, turn, text as source, next_text as target from
    (select *, lead(text) over w as next_text, lead(role) over w as next_role from conversations
    window w as (partition by conv_id order by turn)) where role = 'user' and next_role = 'assistant'"""


@query(f"with {SQL_VOCAB} select token, cast(id as bigint) as id from v")
def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.build_vocab(texts(spark, sf_dir), "text", VOCAB).select("token", F.col("id").cast("bigint"))


@query(f"with {SQL_CODED} select doc_id, {sql_text('ids[1:128]')} as ids from e")
def encode_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_documents(spark, sf_dir, 128)
    return coded.select("doc_id", text_of("input_ids").alias("ids"))


@query(f"with {SQL_CODED} select doc_id, {sql_text('ids')} as ids from e")
def encode_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_documents(spark, sf_dir).select("doc_id", text_of("input_ids").alias("ids"))


@query(f"with {SQL_CODED} select doc_id, {sql_text('ids')} as ids from e")
def encode_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for vocabularies too long for a literal."""
    docs = texts(spark, sf_dir)
    listed = docs.select("doc_id", words("text").alias("tokens"))
    coded = packed_lookup(listed, "tokens", vocab_of(docs), "token", "id", "found", keep=False)
    ids = F.transform("found", lambda i: F.coalesce(i, F.lit(ops.UNKNOWN)))
    return coded.select("doc_id", text_of(ids).alias("ids"))


@query(
    f"""with {SQL_WORDS}, n as (select token, count(*) as n from (select unnest(w) as token from w) group by token),
    v as (select token, row_number() over (order by n desc, token) + 3 as id from n),
    e as ({sql_encode('w', 'doc_id', 'v')}) select doc_id, {sql_text('ids')} as ids from e"""
)
def encode_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full vocabulary, by the way taken for dictionaries of any length."""
    docs = texts(spark, sf_dir)
    listed = docs.select("doc_id", words("text").alias("tokens"))
    vocab = pin(ops.build_full_vocab(docs, "text"), "vocab")
    coded = packed_lookup(listed, "tokens", vocab, "token", "id", "ids", keep=False)
    return coded.select("doc_id", text_of("ids").alias("ids"))


SUBWORDS, LONGEST = 2000, 5
SQL_SPELLED = f"""c as (select word, count(*) as n from (select unnest(w) as word from w) group by word),
    k as (select word, n, unnest(range(0, length(word))) as i from c where length(word) <= 100),
    b as (select case when i > 0 then '##' else '' end || substr(word, (i + 1)::bigint, l) as token, min(l) > 1 as several, sum(n) as n
      from k, range(1, {LONGEST} + 1) r(l) where l <= length(word) - i group by token),
    v as (select token, row_number() over (order by several, n desc, token) + 3 as id from b
      order by several, n desc, token limit {SUBWORDS}),
    g as (select word, 0::bigint as i, []::bigint[] as ids from c where length(word) <= 100
      union all select word, i + max(l), list_append(ids, arg_max(v.id, l)) from
        (select g.*, l, case when i > 0 then '##' else '' end || substr(word, i + 1, l) as token
        from g, range(1, {LONGEST} + 1) r(l) where l <= length(word) - i) join v using (token) group by word, i, ids),
    spelled as (select word, ids from g where i = length(word)),
    e as (select doc_id, flatten(list(coalesce(ids, [1]) order by p)) as ids,
      flatten(list(list_transform(coalesce(ids, [1]), lambda x: p - 1) order by p)) as word_ids from
      (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from w) left join spelled using (word) group by doc_id)"""


@query(
    f"""with recursive {SQL_WORDS}, {SQL_SPELLED} select doc_id, {sql_text('list_concat([2], coalesce(ids, [])[1:510], [3])')} as ids,
    {sql_text('list_concat([null], coalesce(word_ids, [])[1:510], [null])')} as word_ids from w left join e using (doc_id)"""
)
def encode_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words spelled by the longest pieces of a counted vocabulary."""
    docs = texts(spark, sf_dir)
    vocab = pin(ops.subword_vocab(docs, "text", SUBWORDS, LONGEST), "subwords")
    spec = EncoderSpec("subword", width=LONGEST, max_length=512, specials=True)
    coded = ops.encode(docs, "text", spec, vocab, word_ids="word_ids")
    return coded.select("doc_id", text_of("input_ids").alias("ids"), text_of("word_ids").alias("word_ids"))


@query(
    f"""with {SQL_CODED} select doc_id, {sql_text('list_concat([2], ids, [3])')} as ids,
    {sql_text("list_concat([null], range(0, len(ids)), [null])")} as word_ids from e""",
    name="encode_json",
)
def encode_with_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    spec = EncoderSpec("json", specials=True, asset=ops.json_asset(vocab_of(docs)))
    coded = ops.encode(
        docs.select("doc_id", words("text").alias("tokens")), "tokens", spec, word_ids="word_ids"
    )
    return coded.select("doc_id", text_of("input_ids").alias("ids"), text_of("word_ids").alias("word_ids"))


SQL_PAIR_CODED = f"""c as ({SQL_PAIRS}),
    s as (select pair_id, regexp_extract_all(lower(source), {WORDS}) as w from c),
    g as (select pair_id, regexp_extract_all(lower(target), {WORDS}) as w from c),
    v as ({sql_vocab('(select w from s union all select w from g)', VOCAB)}),
    es as ({sql_encode('s', 'pair_id', 'v')}), eg as ({sql_encode('g', 'pair_id', 'v')})"""


@query(
    f"""with {SQL_PAIR_CODED} select pair_id, {sql_text('es.ids[1:128]')} as input_ids,
    {sql_text('eg.ids[1:128]')} as labels from es join eg using (pair_id)"""
)
def encode_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = turn_pairs(spark, sf_dir).withColumns({"source": F.lower("source"), "target": F.lower("target")})
    both = pairs.select(F.col("source").alias("text")).unionByName(pairs.select(F.col("target").alias("text")))
    coded = ops.encode_pair(pairs, "source", "target", EncoderSpec(max_length=128), vocab_of(both))
    return coded.select("pair_id", text_of("input_ids").alias("input_ids"), text_of("labels").alias("labels"))


def piece_spec(max_length: int | None = None, specials: bool = False) -> EncoderSpec:
    return EncoderSpec("chunk", max_length=max_length, width=WIDTH, specials=specials)


def coded_pieces(docs: DataFrame, spec: EncoderSpec) -> DataFrame:
    vocab = pin(ops.build_vocab(docs, "tokens", PIECES, WIDTH))
    return ops.encode(docs, "tokens", spec, vocab, word_ids="word_ids")


SQL_PIECES_CODED = f"""t as ({SQL_TAGGED}), {SQL_PIECES}, v as ({sql_vocab('p', PIECES)}),
    e as ({sql_encode('p', 'doc_id', 'v', 's.word_ids, s.ner_tags, ')}), k as ({SQL_TAG_IDS}),
    m as (select map(list(label), list(id)) as m from k)"""


@query(
    f"""with {SQL_PIECES_CODED} select doc_id, {sql_text('list_concat([2], ids[1:510], [3])')} as ids,
    {sql_text('list_concat([null], word_ids[1:510], [null])')} as word_ids from e"""
)
def encode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_pieces(pin(tagged(spark, sf_dir)), piece_spec(512, specials=True))
    return coded.select("doc_id", text_of("input_ids").alias("ids"), text_of("word_ids").alias("word_ids"))


SQL_ALIGNED = """list_transform(word_ids, lambda x, i: case when i > 1 and x = word_ids[i - 1] then -100
    else m.m[ner_tags[x + 1]] end)"""


@query(f"with {SQL_PIECES_CODED} select doc_id, {sql_text(SQL_ALIGNED)} as labels from e, m")
def align_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pin(tagged(spark, sf_dir))
    coded = encode_label_array(coded_pieces(docs, piece_spec()), label_vocab(docs, "ner_tags"), "ner_tags")
    return ops.align_labels(coded).select("doc_id", text_of("labels").alias("labels"))


@query(f"with {SQL_WORDS} select doc_id, {sql_text(sql_repeat('1', 'len(w)'))} as mask from w")
def attention_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_documents(spark, sf_dir)
    return coded.select("doc_id", text_of(ops.attention_mask(F.col("input_ids"))).alias("mask"))


@query(f"with {SQL_WORDS} select doc_id, len(w) as tokens_input_length from w")
def token_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ops.token_length(coded_documents(spark, sf_dir))
    return coded.select("doc_id", F.col("tokens_input_length").cast("bigint"))


@query(f"with {SQL_VOCAB} select count(*) + 4 as vocab_size from v")
def vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.vocab_size(ops.build_vocab(texts(spark, sf_dir), "text", VOCAB))


SQL_PLACED = f"""{SQL_WORDS}, v as ({sql_vocab('w', VOCAB)}), d as ({sql_hash_split('documents', 'doc_id')}),
    e as ({sql_encode('w', 'doc_id', 'v')}), r as (select doc_id, split, ids from e join d using (doc_id)),
    b as ({sql_batches('r', 'doc_id', 8, sql_shards('r'))}),
    x as (select *, max(len(ids)) over (partition by split, shard, batch_id) as m from b)"""
SQL_KEY = "split, cast(shard as bigint) as shard, cast(batch_id as bigint) as batch_id, cast(pos as bigint) as pos, doc_id"


def placed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.assign_batches(
        coded_documents(spark, sf_dir), "doc_id", 8, shards=document_shards(spark, sf_dir), seed=42
    )


def batch_key() -> list:
    return ["split", *(F.col(c).cast("bigint") for c in ("shard", "batch_id", "pos")), "doc_id"]


@query(
    f"with {SQL_PLACED} select {SQL_KEY}, {sql_text(sql_pad('ids', 'm', '3'))} as ids from x",
)
def pad_token_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = EncoderSpec(pad_id=None)
    padded = pack.pad_to_longest(placed_documents(spark, sf_dir), pad_id=spec.padding)
    return padded.select(*batch_key(), text_of("input_ids").alias("ids"))


@query(
    f"""with d as ({sql_hash_split('documents', 'doc_id')}), b as ({sql_batches('d', 'doc_id', 8, None)})
    select {SQL_KEY} from b"""
)
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = split_documents(spark, sf_dir).select("doc_id", "split")
    return pack.assign_batches(docs, "doc_id", 8, seed=42).select(*batch_key())


@query(
    """select vec_id, cast(0 as bigint) as shard, (row_number() over (order by vec_id) - 1) // 8 as batch_id,
    (row_number() over (order by vec_id) - 1) % 8 as pos from embeddings"""
)
def assign_batches_stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id")
    placed = pack.assign_batches(rows, "vec_id", 8, by=())
    return placed.select("vec_id", *(F.col(c).cast("bigint") for c in ("shard", "batch_id", "pos")))


@query(
    """select conv_id, turn, (row_number() over (order by conv_id, turn) - 1) // 8 as batch_id,
    (row_number() over (order by conv_id, turn) - 1) % 8 as pos from conversations"""
)
def assign_batches_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    placed = pack.assign_batches(rows, ["conv_id", "turn"], 8, by=())
    return placed.select("conv_id", "turn", "batch_id", F.col("pos").cast("bigint"))


SQL_MASK = f"list_concat({sql_repeat('1', 'len(ids)')}, {sql_repeat('0', 'm - len(ids)')})"


@query(
    f"""with {SQL_PLACED} select {SQL_KEY}, {sql_text(sql_pad('ids', 'm', '0'))} as ids,
    {sql_text(SQL_MASK)} as mask from x"""
)
def pad_to_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = pack.pad_to_longest(placed_documents(spark, sf_dir))
    return padded.select(*batch_key(), text_of("input_ids").alias("ids"), text_of("attention_mask").alias("mask"))


@query(
    f"""with {SQL_PLACED} select {SQL_KEY}, {sql_text(sql_pad('ids', 'm', '0'))} as labels,
    {sql_text(sql_pad('ids', 'm', '-100'))} as masked from x"""
)
def labels_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = pack.pad_to_longest(placed_documents(spark, sf_dir))
    copied = pack.labels_copy(pack.labels_copy(padded), mask_padding=True, out="masked")
    return copied.select(*batch_key(), text_of("labels").alias("labels"), text_of("masked").alias("masked"))


@query(f"with {SQL_PLACED} select {SQL_KEY}, {sql_text(sql_pad('ids', 'm', '-100'))} as labels from x")
def labels_masked_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = pack.pad_to_longest(placed_documents(spark, sf_dir))
    return pack.labels_masked_copy(padded).select(*batch_key(), text_of("labels").alias("labels"))


SQL_PAIR_PLACED = f"""{SQL_PAIR_CODED}, r as (select es.pair_id, 'train' as split, es.ids as ids,
    eg.ids as labels from es join eg using (pair_id)), b as ({sql_batches('r', 'pair_id', 2, sql_shards('r'))}),
    x as (select *, max(len(ids)) over q as m, max(len(labels)) over q as n from b
    window q as (partition by split, shard, batch_id))"""


@query(
    f"""with {SQL_PAIR_PLACED} select pair_id, cast(shard as bigint) as shard, cast(batch_id as bigint) as batch_id,
    cast(pos as bigint) as pos, {sql_text(sql_pad('labels', 'n', '0'))} as labels from x"""
)
def labels_pad_separately(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = turn_pairs(spark, sf_dir).withColumns({"source": F.lower("source"), "target": F.lower("target")})
    both = pairs.select(F.col("source").alias("text")).unionByName(pairs.select(F.col("target").alias("text")))
    coded = ops.encode_pair(pairs, "source", "target", EncoderSpec(), vocab_of(both))
    rows = coded.select("pair_id", F.lit("train").alias("split"), "input_ids", "labels")
    padded = pack.labels_pad_separately(pack.assign_batches(rows, "pair_id", 2, shards=shard_count(pairs, ROWS_PER_SHARD), seed=42))
    return padded.select(
        "pair_id", *(F.col(c).cast("bigint") for c in ("shard", "batch_id", "pos")), text_of("labels").alias("labels")
    )


@query(
    f"""with {SQL_PIECES_CODED}, d as ({sql_hash_split('documents', 'doc_id')}),
    l as (select doc_id, split, ids[1:512] as ids, {SQL_ALIGNED} as labels from e join d using (doc_id), m),
    b as ({sql_batches('l', 'doc_id', 8, sql_shards('l'))}),
    x as (select *, max(len(ids)) over (partition by split, shard, batch_id) as m from b)
    select doc_id, {sql_text(f"({sql_pad('labels', 'm', '-100')})[1:m]")} as labels from x"""
)
def labels_pad_to_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of whole texts beside ids of at most 512 pieces."""
    docs = pin(tagged(spark, sf_dir))
    coded = coded_pieces(docs, piece_spec()).withColumn("input_ids", F.slice("input_ids", 1, 512))
    coded = encode_label_array(coded, label_vocab(docs, "ner_tags"), "ner_tags")
    splits = split_documents(spark, sf_dir).select("doc_id", "split")
    rows = ops.align_labels(coded).select("doc_id", "input_ids", "labels").join(splits, "doc_id")
    padded = pack.pad_to_longest(pack.assign_batches(rows, "doc_id", 8, shards=document_shards(spark, sf_dir), seed=42))
    return pack.labels_pad_to_input(padded).select("doc_id", text_of("labels").alias("labels"))


@query(
    f"""with d as ({sql_hash_split('documents', 'doc_id')}), v as (select lang, row_number() over (order by lang) - 1
    as id from (select distinct lang from documents)), r as (select doc_id, split, id from d join v using (lang)),
    b as ({sql_batches('r', 'doc_id', 8, sql_shards('r'))}) select split, cast(shard as bigint) as shard,
    cast(batch_id as bigint) as batch_id, string_agg(id, ',' order by pos) as labels
    from b group by split, shard, batch_id"""
)
def stack_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepkit.operators.labels import build_label_vocab, encode_label

    docs = split_documents(spark, sf_dir).select("doc_id", "split", "lang")
    coded = encode_label(docs, build_label_vocab(docs, "lang"), "lang", "labels")
    stacked = pack.stack_labels(pack.assign_batches(coded, "doc_id", 8, shards=document_shards(spark, sf_dir), seed=42))
    return stacked.select(
        "split", F.col("shard").cast("bigint"), "batch_id", text_of("labels").alias("labels")
    )


@query(
    f"""with {SQL_PLACED} select split, cast(shard as bigint) as shard, cast(batch_id as bigint) as batch_id,
    count(*) as row_count, max(m) as width, cast(sum(m - len(ids)) as bigint) as padded_cells
    from x group by split, shard, batch_id"""
)
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = pack.batch_stats(placed_documents(spark, sf_dir))
    return stats.select(
        "split",
        F.col("shard").cast("bigint"),
        "batch_id",
        F.col("rows").alias("row_count"),
        F.col("width").cast("bigint"),
        "padded_cells",
    )
