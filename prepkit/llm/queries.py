"""The operators of this package as queries over the whole test tables, with equal SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import (
    bloom_search,
    chat,
    decontaminate,
    host_quality,
    html_text,
    impact_search,
    jaccard_join,
    licenses,
    packing,
    periodic_runs,
    pii,
    substring_dedup,
    token_counts,
)
from prepkit.verification.registry import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


SPACED = r"'[^\x20\x09-\x0D]+'"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Speaker marks of the transcripts that ``op1_chat`` makes of conversations, by role and style.
STYLES = {
    "system": ("System: ", "### System: ", "[system] ", "Context: "),
    "user": ("User: ", "### Human: ", "[user] ", "Q: "),
    "assistant": ("Assistant: ", "### Assistant: ", "[assistant] ", "A: "),
}


def transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcript lines, with their true states.

    Each conversation has one of four styles of speaker marks, and one turn in five has no mark; both
    follow hashes of the ids.
    """
    role = F.col("role")
    number, mark = F.lit(None).cast("int"), F.lit("")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4)).cast("int")
    for k, name in enumerate(chat.ROLES):
        number = F.when(role == name, 2 * k).otherwise(number)
        mark = F.when(role == name, F.get(F.array(*map(F.lit, STYLES[name])), style)).otherwise(mark)
    marked = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) != 0
    turns = conversations.select(
        "conv_id", "turn", number.alias("number"), F.when(marked, mark).otherwise("").alias("mark"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("part", "line"),
    )
    return turns.select(
        "conv_id", "turn", "part", F.concat(F.when(F.col("part") == 0, F.col("mark")).otherwise(""), "line").alias("line"),
        (F.col("number") + (F.col("part") > 0).cast("int")).alias("state"),
    )


@_query()
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from transcripts of all conversations."""
    lines = transcripts(table(spark, sf_dir, "conversations"))
    lines = chat.ordered(lines, "conv_id", ["turn", "part"], "line", "state")
    return chat.parse(lines, chat.fit(lines)).withColumnRenamed("key", "conv_id")


@_query(
    f"""
    with recursive d as (select doc_id, coalesce(regexp_extract_all({LOWERED}, {SPACED}), []) as w from documents),
    s as (select distinct doc_id, array_to_string(w[p:p + 4], ' ') as g from
      (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2)::bigint)) as p from d where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    o as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (g)
      where a.doc_id < b.doc_id group by all),
    l as (select x, y from o join n nx on nx.doc_id = x join n ny on ny.doc_id = y
      where 100 * c >= 80 * (nx.n + ny.n - c)),
    e as (select x, y from l union all select y, x from l),
    r as (select x, y from e union select r.x, e.y from r join e on r.y = e.x)
    select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(least_y, d.doc_id)) as component_id
    from d left join n using (doc_id)
    left join (select x as doc_id, min(y) as least_y from r group by x) using (doc_id)
    """
)
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 5-word shingles overlap by four fifths."""
    return jaccard_join.link_classes(table(spark, sf_dir, "documents"))


@_query()
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@_query(
    f"""
    with d as (select doc_id, coalesce(regexp_extract_all(text, {SPACED}), []) as w from documents),
    s as (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1)::bigint)) as p from d),
    g as (select doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) as h from s),
    m as (select h, min(doc_id) as least from g group by h),
    r as (select distinct doc_id, unnest(range(p, p + 13)) as p from g join m using (h) where doc_id > least),
    gone as (select doc_id, list(p) as ps from r group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
      sha256(array_to_string(list_filter(w, lambda x, i: not list_contains(coalesce(ps, []), i)), ' '))
        as kept_sha256
    from d left join gone using (doc_id)
    """
)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept after removing the 13-word windows that an earlier document has."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@_query(
    rf"""
    with d as (select doc_id, coalesce(regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) as w
      from documents),
    b as (select cast(item_id as varchar) as item,
      coalesce(regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) as w from benchmark),
    bw as (select distinct item, least(len(w), 10) as size, array_to_string(w[p:p + 9], ' ') as t
      from (select item, w, unnest(range(1, greatest(len(w) - 8, 2)::bigint)) as p from b where len(w) > 0)),
    sizes as (select distinct size from bw),
    s as (select doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1)::bigint)) as p from d, sizes),
    g as (select doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') as t from s),
    h as (select doc_id, p, size, item from g join bw using (size, t)),
    places as (select doc_id, count(*) as n_hit from
      (select distinct doc_id, unnest(range(p, p + size)) as q from h) group by doc_id),
    found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed from
      (select distinct doc_id, item from h) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
      coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
      coalesce(n_hit, 0) > 0 as contaminated
    from d left join places using (doc_id) left join found using (doc_id)
    """
)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside 10-word windows of benchmark items, and the items."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by byte-pair merging."""
    found = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return found.withColumn("over_limit", F.col("n_tokens") > 4096)


@_query(
    f"""
    with d as (select doc_id, source, coalesce(text, '') as t from documents),
    m as (select doc_id, source, t, regexp_extract_all(t, {SPACED}) as w,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {SPACED})) as ls from d),
    f as (select doc_id, source, w, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, len(ls)::bigint as n_lines,
      (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines from m),
    g as (select doc_id, p, md5(array_to_string(w[p:p + 7], ' ')) as h from
      (select doc_id, w, unnest(range(1, greatest(len(w) - 6, 1)::bigint)) as p from f)),
    again as (select doc_id, h from g group by doc_id, h having count(*) > 1),
    r as (select doc_id, count(distinct q) as n from
      (select doc_id, unnest(range(p, p + 8)) as q from g join again using (doc_id, h)) group by doc_id),
    x as (select doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
      n_words < 20 or 100 * coalesce(n, 0) > 30 * n_words as base_failed,
      (100 * n_symbols > 20 * n_words)::int + (100 * n_dup_lines > 30 * n_lines)::int
        + (word_chars < 2 * n_words or word_chars > 16 * n_words)::int as soft,
      (100 * n_symbols > 10 * n_words)::int + (100 * n_dup_lines > 15 * n_lines)::int
        + (word_chars < 3 * n_words or word_chars > 12 * n_words)::int as strict
      from f left join r using (doc_id)),
    hosts as (select source, count(*) as n, sum((base_failed or soft > 0)::int)::double as bad from x group by source),
    prior as (select sum(bad) / sum(n) as mean, sum(bad * bad / n) / sum(n) as squares, count(*) / sum(n) as few
      from hosts),
    p2 as (select mean, greatest(mean * (1 - mean) / greatest(squares - mean * mean - few * mean * (1 - mean), 1e-6)
      - 1, 1) as strength from prior),
    v as (select source, (bad + mean * strength) / (n + strength) > 0.5 as bad_host, case when bad_host then 0
      when (bad + mean * strength) / (n + strength) < 0.5 * mean then 1 else 0 end as allowed from hosts, p2)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      not base_failed and case when bad_host then strict else soft end <= allowed as kept
    from x join v on x.source is not distinct from v.source
    """
)
def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document, with the source as its host."""
    judged = host_quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of binary length."""
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False
    )


@_query()
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and texts in every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"), licenses.all_templates())
    listed = F.transform("matches", lambda m: F.concat_ws(":", m["template"], m["start"], m["end"]))
    return found.select(
        "doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), F.array_join(listed, ",").alias("matches")
    )


def _listed(kept):
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@_query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and those that the classifier adds."""
    found = pii.find_personal(table(spark, sf_dir, "documents")).withColumn(
        "base", F.filter("spans", lambda s: s["base"])
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "row.doc_id", *(count(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the documents, by the checksum of the id, repeat a part of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    cells = docs.select(
        "doc_id", "text", (h % 10).alias("h"), F.floor(h / 10).cast("long").alias("g"),
    )
    cells = cells.withColumn(
        "w", F.when(F.col("h") == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    ).withColumn("n", F.size("w"))
    cells = cells.withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int")).withColumn(
        "times", (F.col("g") % 8 + 3).cast("int")
    )
    period = (F.floor((F.col("n") - F.col("a")) / F.col("times")) + 1).cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, period), F.col("times")))
    planted = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), again), F.lit(1), F.col("n")), " ")
    return cells.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@_query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of them planted, and the texts without their repeats."""
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic_runs.longest_run())
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


@_query(
    rf"""
    with terms as (select doc_id, unnest(regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as t from documents),
    tf as (select doc_id, t, count(*) as tf from terms group by all),
    n as (select doc_id, count(*) as n from terms group by doc_id),
    c as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from n),
    df as (select t, count(*) as df from tf group by t),
    w as (select t, floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)))::bigint as w from df, c),
    m as (select doc_id, (50 + (50 * n * big_n) // big_l)::bigint as m from n, c),
    items as (select distinct item_id, unnest(regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) as t
      from benchmark),
    s as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
      from items join tf using (t) join w using (t) join m using (doc_id) group by all),
    r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from s where score > 0)
    select item_id, rank, doc_id, score from r where rank <= 50
    """
)
def op12_bloom_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return bloom_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query(
    """
    with v as (select vec_id, row_number() over () as number, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
      from embeddings where embedding is not null
        and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
    s as (select q.number, q.vec_id as query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::bigint as score
      from v q join v on q.number <> v.number where q.vec_id % 50 = 0),
    r as (select *, row_number() over (partition by number order by score desc, vec_id)::int as rank from s)
    select query_id, rank, vec_id, score from r where rank <= 5
    """
)
def op13_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other vectors of every fiftieth one."""
    return impact_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
