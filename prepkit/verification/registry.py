"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function name, with equal SQL where SQL can say it."""

    def register(fn: Query) -> Query:
        title = name or fn.__name__
        if title in QUERIES:
            raise ValueError(f"query {title} registered twice")
        QUERIES[title] = fn
        if sql is not None:
            ORACLES[title] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: Column | str) -> Column:
    """An array of numbers as comma-separated text, missing elements as ``null``."""
    col = F.col(col) if isinstance(col, str) else col
    return F.array_join(col.cast("array<string>"), ",", "null")


def micro_text(col: Column | str) -> Column:
    """An array of fractions as text, in whole millionths."""
    col = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(col, lambda v: F.round(v.cast("double") * 1e6).cast("bigint").cast("string")), ",")


# SQL pieces shared by the twins. `{seed}` orders and splits follow md5 of "42:key".

WORDS = r"'[^ \t\n\x0B\f\r]+'"


def sql_text(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda v: coalesce(cast(v as varchar), 'null')), ',')"


def sql_micro(expr: str) -> str:
    return (
        f"array_to_string(list_transform({expr}, "
        "lambda v: cast(cast(round(cast(v as double) * 1e6) as bigint) as varchar)), ',')"
    )


def sql_exact_split(source: str, key: str) -> str:
    """Rows of ``source`` with ``split``: ceil(15 %) of them, first in md5 order, are validation."""
    h = f"md5('42:' || cast({key} as varchar))"
    return (
        f"select *, case when row_number() over (order by {h}, {key}) <= "
        f"ceil(0.15 * (select count(*) from {source})) then 'validation' else 'train' end as split from {source}"
    )


def sql_hash_split(source: str, key: str) -> str:
    return (
        f"select *, case when substr(md5('42:' || cast({key} as varchar)), 1, 8) <= '26666666' "
        f"then 'validation' else 'train' end as split from {source}"
    )


def sql_vocab(words: str, size: int) -> str:
    """``token, id`` of the commonest elements of the list column ``w`` of ``words``."""
    return (
        "select token, row_number() over (order by n desc, token) + 3 as id from "
        f"(select token, count(*) as n from (select unnest(w) as token from {words}) "
        f"group by token order by n desc, token limit {size})"
    )


def sql_encode(words: str, key: str, vocab: str, extra: str = "") -> str:
    """``key, ids`` (and ``extra`` columns) of the list column ``w`` of ``words``."""
    return (
        f"select s.{key}, {extra} coalesce(e.ids, []) as ids from {words} s left join "
        f"(select {key}, list(coalesce(v.id, 1) order by p) as ids from "
        f"(select {key}, unnest(w) as t, generate_subscripts(w, 1) as p from {words}) x "
        f"left join {vocab} v on v.token = x.t group by {key}) e on e.{key} = s.{key}"
    )


ROWS_PER_SHARD = 100


def sql_shards(source: str) -> str:
    """The number of shards for all rows of ``source``."""
    return f"(select greatest(1, cast(ceil(count(*) / {ROWS_PER_SHARD}.0) as bigint)) from {source})"


def sql_batches(source: str, key: str, size: int, shards: str | None) -> str:
    """Rows of ``source`` with ``shard, batch_id, pos`` by md5 order inside each split."""
    h = f"md5('42:' || cast({key} as varchar))"
    shard = "0" if shards is None else f"cast(floor(cast('0x' || substr({h}, 1, 4) as bigint) * {shards} / 65536) as int)"
    return (
        "select * exclude (rn), (rn - 1) // "
        f"{size} as batch_id, (rn - 1) % {size} as pos from (select *, row_number() over "
        f"(partition by split, shard order by {key}_h, {key}) as rn from "
        f"(select *, {shard} as shard, {h} as {key}_h from {source}))"
    )


def sql_pad(expr: str, width: str, fill: str) -> str:
    return f"list_concat({expr}, list_transform(range(0, {width} - len({expr})), lambda k: {fill}))"


def sql_repeat(value: str, times: str) -> str:
    return f"list_transform(range(0, {times}), lambda k: {value})"
