"""Dictionary lookup over array columns.

A map lookup in Spark SQL walks the map, so a dictionary becomes an array of small maps addressed by a hash
of the key: one array access and one short walk per token. A dictionary of up to ``LITERAL_ROWS`` entries is
a literal of the plan. A longer one comes to the rows instead, in parts: consecutive rows form a chunk, whose
distinct tokens are numbered in Arrow batches and meet the dictionary, and what they find comes back to the
rows of the chunk as one array. So a token of a row costs one access to it, and tokens are never shuffled one
by one, however long the dictionary is.

Entries are unique: an entry that a dictionary holds twice fails the job either way.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.arrow import small_parts
from prepkit.session import pin, small_side

LITERAL_ROWS = 100_000
LITERAL_CHARS = 8_000_000
ENTRY_CHARS = 10_000
#: Bytes of the tokens of a chunk of several rows, and chunks that may meet one copy of a dictionary entry.
CHUNK_BYTES, CHUNKS_PER_COPY = 4 << 20, 1_000_000


def _slot(token: Column, slots: int) -> Column:
    return F.hash(token).bitwiseAND(F.lit(slots - 1))


def literal_lookup(table: DataFrame, key: str, value: str) -> Callable[[Column], Column] | None:
    """A function from a column to the value found in ``table``, or None if the table is too long."""
    entry = F.col(key).cast("string")
    kind = table.schema[value].dataType
    found = table.select(entry, F.col(value), F.hash(entry)).where(entry.isNotNull()).limit(LITERAL_ROWS + 1).collect()
    lengths = [len(row[0]) for row in found]
    if len(found) > LITERAL_ROWS or sum(lengths) > LITERAL_CHARS or max(lengths, default=0) > ENTRY_CHARS:
        return None
    slots = 1 << max(4, (2 * len(found)).bit_length())
    maps: list[dict[str, object]] = [{} for _ in range(slots)]
    for text, number, h in found:
        if text in maps[h & (slots - 1)]:
            raise ValueError(f"the dictionary holds {text!r} more than once")
        maps[h & (slots - 1)][text] = number
    literal = F.from_json(F.lit(json.dumps(maps, ensure_ascii=False)), f"array<map<string,{kind.simpleString()}>>")

    def find(word: Column) -> Column:
        word = word.cast("string")
        return F.get(literal, _slot(word, slots))[word]

    return find


def _coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """For each list its chunk and the places of its tokens among the chunk's; the first list of a chunk has these."""
    chunk = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in small_parts(batch, CHUNK_BYTES):
            offsets = part.offsets.to_numpy()
            tokens = part.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            n = len(part)
            codes = pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), tokens.indices, mask=part.is_null())
            first = np.full(n + 1, len(tokens.dictionary), np.int32)
            first[0] = 0
            entries = pa.ListArray.from_arrays(pa.array(first), tokens.dictionary)
            yield pa.StructArray.from_arrays(
                [pa.array(np.full(n, chunk)), codes, entries], ["chunk", "codes", "entries"]
            )
            chunk += 1


def packed_lookup(
    df: DataFrame, tokens: str, table: DataFrame, entry: str, number: str, out: str, keep: bool = True
) -> DataFrame:
    """The same lookup for a dictionary of any length; without ``keep`` the tokens are left out.

    Rows are stored with their chunk and their tokens as places in it, so that all reads agree on them, and are
    joined once, whole, by chunk. The distinct tokens of a chunk are shuffled instead of its tokens; a token of
    all chunks meets as many copies of its entry as their number asks for.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if keep or c != tokens))
    # Chunks are numbered by task: not deterministic, so that it stays in the stage that stores the rows.
    code = F.arrow_udf(_coded, "chunk long, codes array<int>, entries array<string>")
    coded = code.asNondeterministic()(F.col(tokens).cast("array<string>"))
    numbered = pin(df.select(row.alias("__row"), coded.alias("__c")).select("__row", "__c.*"), "chunks")
    listed = numbered.where(F.size("entries") > 0).select("chunk", "entries")
    copies = max(1, listed.count() // CHUNKS_PER_COPY)
    places = listed.select("chunk", F.posexplode("entries").alias("__p", "__t"))
    seen = places.groupBy("chunk", "__t").agg(F.min("__p").alias("__p"))
    entries = table.select(F.col(entry).cast("string").alias("__t"), F.col(number).alias("__n")).where("__t is not null")
    if copies == 1:
        hits = seen.join(small_side(pin(entries, "entries")), "__t", "left")
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        salted = seen.withColumn("__s", F.pmod("chunk", F.lit(copies)).cast("int"))
        hits = salted.join(entries.withColumn("__s", salt), ["__t", "__s"], "left")
    # A place of its own for each token of the chunk, found or not.
    lists = hits.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("__p", "__n"))).alias("__f"))
    twice = F.raise_error(F.lit("the dictionary holds an entry more than once"))
    once = F.when(F.element_at("__f", -1)["__p"] < F.size("__f") - 1, twice.cast(lists.schema["__f"].dataType))
    packed = lists.select("chunk", F.coalesce(once, "__f")["__n"].alias("__d"))
    joined = numbered.select("__row", "chunk", "codes").join(packed, "chunk", "left")
    return joined.select("__row.*", F.transform("codes", lambda c: F.get("__d", c)).alias(out))


def map_array(
    df: DataFrame,
    tokens: str,
    table: DataFrame,
    entry: str,
    number: str,
    out: str,
    default: object = None,
    keep: bool = True,
) -> DataFrame:
    """Add ``out``: the value of each element of ``tokens``, ``default`` where it is not in ``table``.

    The way taken depends on the length of ``table``, the result does not. Without ``keep`` the tokens are left out.
    """
    kind: T.DataType = table.schema[number].dataType
    missing = F.lit(default).cast(kind)
    find = literal_lookup(table, entry, number)
    if find is not None:
        found = find if default is None else lambda token: F.coalesce(find(token), missing)
        coded = df.withColumn(out, F.transform(F.col(tokens), found))
        return coded if keep else coded.drop(tokens)
    joined = packed_lookup(df, tokens, table, entry, number, out, keep)
    return joined.withColumn(out, F.transform(out, lambda n: F.coalesce(n, missing)))
