"""Sub-word pieces: a vocabulary of counted pieces, and words spelled by greedy longest match.

Pieces inside a word carry a mark, so that a piece at the beginning of a word is another token. Both steps work on
distinct words, never on their occurrences. The longest match at each place is followed from the beginning
of the word: in an expression where the vocabulary is short enough for a literal, and otherwise after an
equi-join of the spans of words with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prepkit.functions.bind import bind
from prepkit.functions.lookup import literal_lookup
from prepkit.session import pin, small_side

#: A piece that continues a word begins with this; words of more characters are unknown as a whole.
MARK, MOST_CHARS = "##", 100


def _spans(words: DataFrame, word: str, longest: int) -> DataFrame:
    """Every row of ``words`` with each ``start``, ``length`` and ``piece`` of up to ``longest`` characters of its word."""
    short = words.where(F.length(word).between(1, MOST_CHARS))
    starts = short.withColumn("start", F.explode(F.sequence(F.lit(0), F.length(word) - 1)))
    most = F.least(F.lit(longest), F.length(word) - F.col("start"))
    spans = starts.withColumn("length", F.explode(F.sequence(F.lit(1), most)))
    mark = F.when(F.col("start") > 0, F.lit(MARK)).otherwise("")
    return spans.withColumn("piece", F.concat(mark, F.substr(word, F.col("start") + 1, F.col("length"))))


def build_subwords(counted: DataFrame, size: int, longest: int, first_id: int) -> DataFrame:
    """Table ``(token, id)`` of the ``size`` commonest pieces of the words ``(token, count)``, single characters first.

    A piece counts as often as the words occur that hold it, once for each of its places in them.
    """
    counts = (
        _spans(counted, "token", longest)
        .groupBy("piece")
        .agg(F.sum("count").alias("count"), (F.min("length") > 1).alias("several"))
    )
    order = ("several", F.desc("count"), "piece")
    rank = F.row_number().over(W.orderBy(*order))
    top = counts.orderBy(*order).limit(size)
    return top.select(F.col("piece").alias("token"), (rank + (first_id - 1)).cast("int").alias("id"))


def spell(words: DataFrame, word: str, vocab: DataFrame, longest: int, unknown: int) -> DataFrame:
    """``word, ids`` of distinct words: at each place the longest piece of the vocabulary (``token, id``).

    A word that cannot be spelled to its end is ``unknown``, and so is one of more than ``MOST_CHARS``
    characters; an empty word has no ids, a missing one is left out.
    """
    named = words.select(F.col(word).alias("word")).where("word is not null")
    entries = vocab.select(F.col("token").alias("piece"), "id").where("piece is not null")
    pinned = pin(entries.groupBy("piece").agg(F.min("id").alias("id")), "pieces")
    find = literal_lookup(pinned, "piece", "id")
    if find is not None:
        end = F.when(F.length("word") <= MOST_CHARS, _walk(F.col("word"), find, longest))
        joined = named.select("word", end.alias("end"))
    else:
        joined = named.join(_walk_by_join(named, pinned, longest), "word", "left")
    whole = F.col("end.at") == F.length("word")
    ids = F.when(whole, F.col("end.ids")).when(F.length("word") > 0, F.array(F.lit(unknown)))
    return joined.select("word", F.coalesce(ids, F.array().cast("array<int>")).alias("ids"))


def _begin() -> Column:
    return F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ids"))


def _on(state: Column, length: Column, piece_id: Column) -> Column:
    return F.struct((state["at"] + length).alias("at"), F.concat(state["ids"], F.array(piece_id)).alias("ids"))


def _walk(word: Column, find: Callable[[Column], Column], longest: int) -> Column:
    """``at, ids`` where the longest matches end, by a lookup of each piece; words are not shuffled."""

    def step(state: Column, start: Column) -> Column:
        def taken(length: Column) -> Column:
            mark = F.when(start > 0, F.lit(MARK)).otherwise("")
            return F.struct(length.alias("length"), find(F.concat(mark, F.substr(word, start + 1, length))).alias("id"))

        def shorter(found: Column, length: Column) -> Column:
            fits = found["id"].isNull() & (start + length <= F.length(word))
            return F.when(fits, taken(length)).otherwise(found)

        none = F.struct(F.lit(0).alias("length"), F.lit(None).cast("int").alias("id"))
        # As one argument, so that it is looked up once.
        best = F.aggregate(F.sequence(F.lit(longest), F.lit(1)), none, shorter)
        on = bind(best, lambda b: F.when(b["id"].isNotNull(), _on(state, b["length"], b["id"])).otherwise(state))
        return F.when(state["at"] == start, on).otherwise(state)

    # A place without a match is never left, so the word does not end.
    return F.aggregate(F.sequence(F.lit(0), F.greatest(F.length(word) - 1, F.lit(0))), _begin(), step)


def _walk_by_join(named: DataFrame, entries: DataFrame, longest: int) -> DataFrame:
    """``word`` and the same ``end`` for a vocabulary of any length."""
    hits = _spans(named, "word", longest).join(small_side(entries), "piece")
    # By start, the longest first: the first span at the place reached is the one to take.
    listed = F.array_sort(F.collect_list(F.struct("start", (-F.col("length")).alias("less"), "id")))
    found = hits.groupBy("word").agg(listed.alias("spans"))

    def follow(state: Column, span: Column) -> Column:
        return F.when(span["start"] == state["at"], _on(state, -span["less"], span["id"])).otherwise(state)

    return found.select("word", F.aggregate("spans", _begin(), follow).alias("end"))
