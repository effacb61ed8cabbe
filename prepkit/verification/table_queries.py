"""Sources, sinks, checks, projections, splits."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.config import LanguageModelJob, TextClassJob, job_from_json
from prepkit.functions.text import to_text
from prepkit.operators.batches import assign_batches
from prepkit.operators.checks import keep_complete, missing_features, require_columns, require_features
from prepkit.operators.labels import build_label_vocab
from prepkit.operators.maps import collate_fn as collate
from prepkit.operators.maps import filter_rows as keep_rows
from prepkit.operators.maps import map_batches as map_in_batches
from prepkit.operators.maps import map_rows as map_each
from prepkit.operators.positions import shard_count
from prepkit.operators.splits import head_n as first_n
from prepkit.operators.splits import head_per_split
from prepkit.operators.splits import split_exact as cut_exact
from prepkit.operators.splits import split_hash as cut_hash
from prepkit.operators.tokens import EncoderSpec, build_vocab, encode, json_asset
from prepkit.plans.jobs import input_paths
from prepkit.plans.language_model import lm_features
from prepkit.session import new_path
from prepkit.sinks import store
from prepkit.sources import scan
from prepkit.verification.registry import (
    ROWS_PER_SHARD,
    WORDS,
    query,
    sql_batches,
    sql_encode,
    sql_exact_split,
    sql_hash_split,
    sql_shards,
    sql_text,
    sql_vocab,
    table,
    text_of,
)

CONFIGS = Path(__file__).resolve().parents[2] / "configs"
HASHED = f"with d as ({sql_hash_split('documents', 'doc_id')})"


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_hash(table(spark, sf_dir, "documents"), "doc_id")


@query(f"{HASHED} select doc_id, n_chars, lang, split from d where split = 'train'")
def scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "scan")
    split_documents(spark, sf_dir).write.partitionBy("split").parquet(path)
    return scan.scan_split(spark, path, "train").select("doc_id", "n_chars", "lang", "split")


@query(
    f"""{HASHED}, r as (select doc_id, n_chars, split, row_number() over (partition by split order by doc_id) as rn,
    count(*) over (partition by split) as n from d)
    select 'first' as part, doc_id, n_chars, split from r where split = 'train' and rn <= round_even(n * 10 / 100.0, 0)
    union all select 'inner', doc_id, n_chars, split from r where split = 'train' and rn between 101 and 200
    or split = 'validation' and rn > n - 5
    union all select 'last', doc_id, n_chars, split from r where split = 'train' and rn > n - round_even(n * 25 / 100.0, 0)
    or split = 'validation'"""
)
def scan_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of stored splits, in rows and per cent, from both ends."""
    path = new_path(spark, "slices")
    split_documents(spark, sf_dir).write.partitionBy("split").parquet(path)
    named = {"first": "train[:10%]", "inner": "train[100:200] + validation[-5:]", "last": "train[-25%:]+validation"}
    parts = [
        scan.scan_slice(spark, path, text, "doc_id").select(F.lit(name).alias("part"), "doc_id", "n_chars", "split")
        for name, text in named.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """select doc_id, source as origin, 'train' as split from documents where lang = 'en'
    union all select doc_id, source, 'validation' from documents where lang <> 'en'"""
)
def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("origin"), "lang")
    english = docs.where("lang = 'en'").drop("lang")
    other = docs.where("lang <> 'en'").drop("lang")
    return scan.union_splits({"train": english, "validation": other})


def declared_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings stored with class names declared for ``label`` and for an array of labels."""
    names = [f"class {chr(106 - i)}" for i in range(10)]
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.array("label", F.pmod(F.col("label") + 1, F.lit(10))).alias("pair")
    )
    path = new_path(spark, "declared")
    scan.declare_labels(scan.declare_labels(vectors, "label", names), "pair", names).write.parquet(path)
    return scan.scan_split(spark, path)


@query(
    """select vec_id, label, 'class ' || chr(106 - label) as declared_name,
    'class ' || chr(106 - (label + 1) % 10) as second_name from embeddings"""
)
def label_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = declared_embeddings(spark, sf_dir)
    names = F.array(*map(F.lit, scan.declared_labels(stored, "label")))
    of_pair = F.array(*map(F.lit, scan.declared_labels(stored, "pair")))
    assert isinstance(scan.label_element_type(stored, "pair"), T.IntegerType)
    return stored.select(
        "vec_id",
        "label",
        names[F.col("label")].alias("declared_name"),
        of_pair[F.col("pair")[1]].alias("second_name"),
    )


@query(
    f"""{HASHED}, w as (select doc_id, split, regexp_extract_all(lower(text), {WORDS}) as w from d),
    v as ({sql_vocab("(select * from w where split = 'train')", 5000)}),
    e as ({sql_encode('w', 'doc_id', 'v', 's.split,')})
    select doc_id, split, {sql_text('ids[1:128]')} as ids, least(len(ids), 128) as tokens_input_length from e"""
)
def job_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = job_from_json(LanguageModelJob, str(CONFIGS / "language_model.json"))
    coded = lm_features(split_documents(spark, sf_dir), job)
    return coded.select("doc_id", "split", text_of("input_ids").alias("ids"), "tokens_input_length")


@query(f"{HASHED} select split, count(*) as row_count, sum(n_chars) as chars from d group by split")
def write_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "prepared")
    docs = split_documents(spark, sf_dir)
    report = store.write_prepared(docs, path)
    chars = spark.read.parquet(path).groupBy("split").agg(F.sum("n_chars").alias("chars"))
    return (
        report.groupBy("split").agg(F.sum("rows").alias("row_count")).join(chars, "split")
        .select("split", "row_count", "chars")
    )


@query(f"{HASHED} select doc_id, split, n_chars, 'false,true,false,true,false,false' as reused from d")
def prepared_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings of a job, through reuse, overwriting, another output folder, and a changed vocabulary."""
    root, vocabulary = new_path(spark, "cache"), new_path(spark, "vocabulary")
    docs = table(spark, sf_dir, "documents")

    def write_vocabulary(languages: DataFrame) -> None:
        store.write_label_vocab(build_label_vocab(languages, "lang"), vocabulary)

    write_vocabulary(docs)
    job = TextClassJob(
        dataset_name=f"{sf_dir}/documents.parquet", key_column_name="doc_id", text_column_name="text",
        label_column_name="lang", label_vocab_path=vocabulary, output_dir="first", trainer={"learning_rate": 1},
    )

    def build() -> DataFrame:
        return split_documents(spark, sf_dir).select("doc_id", "n_chars", "split")

    found = []
    for change, overwrite in (
        ({}, False), ({}, False), ({}, True), ({"output_dir": "second", "trainer": {"learning_rate": 2}}, False),
        ({"seed": 1}, False), (None, False),
    ):
        if change is None:
            write_vocabulary(docs.where("lang = 'en'"))
        asked = replace(job, **(change or {}))
        stored, hit = store.prepared_cache(spark, root, asked.shaping(), input_paths(asked), build, overwrite)
        found.append(str(hit).lower())
    return stored.select("doc_id", "split", "n_chars", F.lit(",".join(found)).alias("reused"))


@query("select lang as label, row_number() over (order by lang) - 1 as id from (select distinct lang from documents)")
def write_label_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = build_label_vocab(table(spark, sf_dir, "documents"), "lang")
    return store.write_label_vocab(vocab, new_path(spark, "labels")).select("label", F.col("id").cast("bigint"))


@query(
    f"""with w as (select doc_id, regexp_extract_all(text, {WORDS}) as w from documents),
    v as ({sql_vocab('w', 2000)}), e as ({sql_encode('w', 'doc_id', 'v')})
    select doc_id, {sql_text('ids')} as ids from e"""
)
def write_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    asset = json_asset(build_vocab(docs, "text", 2000))
    folder = new_path(spark, "assets")
    paths = store.write_assets(spark, folder, {"tokenizer.json": asset, "pixels.json": {"scale": 1 / 255}})
    stored = spark.read.option("wholetext", True).text(paths[0]).first()["value"]
    coded = encode(docs, "text", EncoderSpec("json", asset=stored))
    return coded.select("doc_id", text_of("input_ids").alias("ids"))


@query(
    f"""{HASHED} select 'lengths' as run, split, metric, round(value, 6) as value from
    (select split, avg(n_chars) as mean_chars, cast(count(*) as double) as samples from d group by split)
    unpivot (value for metric in (mean_chars, samples))"""
)
def write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepkit.operators.scoring import metrics_rows

    path = new_path(spark, "metrics")
    docs = split_documents(spark, sf_dir)
    for split in ("train", "validation"):
        summary = docs.where(F.col("split") == split).agg(
            F.avg("n_chars").alias("mean_chars"), F.count(F.lit(1)).alias("samples")
        )
        store.write_metrics(metrics_rows(summary, "lengths", split), path)
    return spark.read.parquet(path).withColumn("value", F.round("value", 6))


@query("select doc_id, text, lang from documents", name="require_columns")
def require_columns_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return require_columns(docs, {"doc_id": T.LongType, "text": T.StringType, "lang": None}).select(
        "doc_id", "text", "lang"
    )


@query(
    """select source, cast(count(*) filter (quality is null) as bigint) as missing, count(*) as total
    from documents left join labels using (doc_id) group by source""",
    name="require_features",
)
def require_features_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    require_features(docs, "text")
    joined = docs.select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return missing_features(joined, "quality", by=["source"])


@query(
    """select model_type, model_type in ('causal-lm', 'seq2seq') as accepted, count(*) as documents from
    (select unnest(['causal-lm', 'seq2seq', lang, source]) as model_type from documents) group by model_type"""
)
def require_model_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a column, and whether a job with each is accepted; the values are few."""
    named = F.explode(F.array(F.lit("causal-lm"), F.lit("seq2seq"), F.col("lang"), F.col("source")))
    found = table(spark, sf_dir, "documents").select(named.alias("model_type")).groupBy("model_type")
    counts = found.agg(F.count(F.lit(1)).alias("documents"))

    def accepted(name: str) -> bool:
        try:
            return LanguageModelJob(model_type=name).model_type == name
        except ValueError:
            return False

    return map_each(counts, accepted, "boolean", "accepted", "model_type").select("model_type", "accepted", "documents")


@query("select doc_id, length(text) as text_length from documents")
def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("text_length", F.length("text").cast("bigint")).select("doc_id", "text_length")


@query("select doc_id, lang, source, n_chars, lang || ':' || source as label, length(text) as size from documents")
def append_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    added = docs.withColumns(
        {"label": F.concat_ws(":", "lang", "source"), "size": F.length("text").cast("bigint")}
    )
    return added.drop("text")


@query("select doc_id, lower(text) as text from documents")
def lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))


QUOTED = r"""case when contains(v, '''') and not contains(v, '"')
    then '"' || replace(replace(replace(replace(v, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"'
    else '''' || replace(replace(replace(replace(replace(v, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t'),
    '''', '\''') || '''' end"""


@query(
    f"""select page_id, coalesce('[' || array_to_string(list_transform(parts,
    lambda v: {QUOTED}), ', ') || ']', 'None') as caption from
    (select page_id, list_value(url, url || chr(9) || '''' || chr(92), 'say "' || url || '"', '''' || url || '"')
     || string_split(substr(html, 1, length(html)), chr(10)) as parts from pages)""",
    name="to_text",
)
def to_text_repr(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    parts = F.concat(
        F.array(
            F.col("url"),
            F.concat("url", F.lit("\t'\\")),
            F.concat(F.lit('say "'), "url", F.lit('"')),
            F.concat(F.lit("'"), "url", F.lit('"')),
        ),
        F.split("html", "\n"),
    )
    listed = pages.select("page_id", parts.alias("parts"))
    return listed.select("page_id", to_text(F.col("parts"), listed.schema["parts"].dataType).alias("caption"))


@query("select doc_id, source, quality from documents left join labels using (doc_id) where quality is not null")
def keep_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    joined = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return keep_complete(joined, ["source", "quality"])


@query(
    f"""{HASHED} select doc_id, split, n_chars from (select *, row_number() over (partition by split order by doc_id) as rn
    from d) where rn <= case split when 'train' then 100 else 40 end"""
)
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"train": 100, "validation": 40}
    return head_per_split(split_documents(spark, sf_dir).select("doc_id", "split", "n_chars"), "doc_id", limits)


@query("select conv_id, turn, role from conversations order by conv_id, turn limit 100")
def head_n_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_n(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], 100)


@query("select label, row_number() over (order by label) - 1 as id from (select distinct source as label from documents)")
def sort_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = build_label_vocab(table(spark, sf_dir, "documents"), "source")
    return vocab.select("label", F.col("id").cast("bigint")).orderBy("label")


@query(f"with d as ({sql_exact_split('documents', 'doc_id')}) select doc_id, split from d")
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_exact(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(
    """select conv_id, turn, case when row_number() over (order by md5('42:' || conv_id || ':' || turn), conv_id, turn)
    <= ceil(0.15 * (select count(*) from conversations)) then 'validation' else 'train' end as split
    from conversations"""
)
def split_exact_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return cut_exact(rows, ["conv_id", "turn"])


@query(f"{HASHED} select doc_id, split from d")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_hash(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("select doc_id, upper(lang) as lang, length(text) as size from documents")
def map_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def measure(batch: dict[str, list]) -> dict[str, list]:
        return {
            "doc_id": batch["doc_id"],
            "lang": [v.upper() for v in batch["lang"]],
            "size": [len(v) for v in batch["text"]],
        }

    docs = table(spark, sf_dir, "documents")
    return map_in_batches(
        docs, measure, "doc_id bigint, lang string, size bigint", 100, columns=["doc_id", "lang", "text"]
    )


@query("select doc_id, lang || '/' || source || '/' || length(text) as tag from documents")
def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    tagged = map_each(
        docs, lambda lang, source, text: f"{lang}/{source}/{len(text)}", "string", "tag", "lang", "source", "text"
    )
    return tagged.select("doc_id", "tag")


@query("select doc_id, lang, n_chars from documents where lang <> 'en' and n_chars >= 200")
def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return keep_rows(docs, (F.col("lang") != "en") & (F.col("n_chars") >= 200)).select("doc_id", "lang", "n_chars")


@query(
    f"""{HASHED}, b as ({sql_batches('d', 'doc_id', 8, sql_shards('d'))})
    select split, shard, batch_id, string_agg(lang, ',' order by pos) as langs, max(n_chars) as longest
    from b group by split, shard, batch_id"""
)
def collate_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    import pandas as pd

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "split": [first["split"]],
                "shard": [first["shard"]],
                "batch_id": [first["batch_id"]],
                "langs": [",".join(rows["lang"])],
                "longest": [rows["n_chars"].max()],
            }
        )

    docs = split_documents(spark, sf_dir).select("doc_id", "split", "lang", "n_chars")
    placed = assign_batches(docs, "doc_id", 8, shards=shard_count(docs, ROWS_PER_SHARD), seed=42)
    return collate(placed, gather, "split string, shard int, batch_id bigint, langs string, longest bigint")
