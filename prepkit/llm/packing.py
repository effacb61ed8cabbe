"""Packing by powers of two: every document is split into pieces of binary length.

A document's ids are cut by the binary digits of their number: as many pieces of the full length as fit,
then one for each further set digit, longest first. A piece is a sequence of its own, so no sequence
crosses documents and none needs padding; sequences of one length form a bucket, which is read as batches
of equal shape. Nothing is shuffled: sequence ids are unique and follow the order of rows and places.

Words between white space are encoded by the tokenizers library once per task and remembered, up to a fixed
number of words; the tokenizer's pattern never joins characters over white space.

Defined cases: a null or empty text has only the closing id; texts are never cut short; rows that share a
key are separate documents; an empty table gives no pieces.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from collections.abc import Callable
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm import words as W
from prepkit.llm.exchange import is_in
from prepkit.session import short_batches

MAX_LENGTH, END_ID = 2048, 1
#: Words remembered by a task (and eight times as many ids); beyond, remembering starts anew. Words in one call.
REMEMBERED, AT_ONCE = 400_000, 1000
#: Bytes of text encoded at a time.
CHUNK_BYTES = 1 << 18


def pieces(total: int, longest: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of ``total`` ids: powers of two, longest first."""
    out = [longest] * (total // longest)
    rest = total % longest
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


Coded = list[tuple[np.ndarray, np.ndarray]]


class WordIds:
    """Ids of texts by a tokenizer whose pattern never crosses white space.

    Words are handled as arrays of hashes. A word is cut before the stops that end it, where the pattern
    cuts it too (after a letter or digit, a run of stops is a piece of its own), and ASCII words are put in
    lower case, as the tokenizer does. Words with an angle bracket may hold special strings and stay whole.
    Words of Latin letters are one piece each, so the model alone encodes them, without normaliser and pattern.
    """

    def __init__(self, spec: str, ends: np.ndarray | None = None):
        from tokenizers import Tokenizer

        # Spark already runs one task per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.ends = word_ends(self.tokenizer) if ends is None else ends
        self.bare, self.simple = bare_tokenizer(self.tokenizer, self.ends)
        self._reset()

    def _reset(self) -> None:
        self.known, self.number, self.table = np.zeros(0, np.uint64), np.zeros(0, np.int64), _Table()

    def _encode(self, texts: list[str], call: Callable) -> Coded:
        return [call(texts[at : at + AT_ONCE]) for at in range(0, len(texts), AT_ONCE)]

    def _by_model(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of simple letters, one after another, and how many each has."""
        text = " ".join(some).lower()
        if not text.isascii():
            text = codecs.charmap_decode(text.encode(), "strict", _BYTE_LETTERS)[0]
        return self._sized(self.bare, text, len(some)) or self._by_places(some)

    def _by_ends(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of any letters: each is one piece of the pattern, so that marked ids end them."""
        return self._sized(self.tokenizer, " ".join(some), len(some)) or self._by_places(some)

    def _sized(self, tokenizer, text: str, n: int) -> tuple[np.ndarray, np.ndarray] | None:
        [found] = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(last, prepend=-1)) if len(last) == n else None

    def _by_places(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for all words, by the places of their ids."""
        starts = np.cumsum([0] + [len(w) + 1 for w in some[:-1]])
        found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
        where = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(found.offsets))
        size = np.bincount(np.searchsorted(starts, where, "right") - 1, minlength=len(some))
        return np.array(found.ids, np.uint32), size

    def rows(self, chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a chunk, and where each row's begin among them."""
        if len(self.known) > REMEMBERED or len(self.table.flat) > 8 * REMEMBERED:
            self._reset()
        found = W.find_words(chunk, hashed=False)
        start, end, keys, plain, filled = _parts(chunk.data, found)
        # Equal keys side by side: the first of each run stands for all.
        order = np.argsort(keys)
        fresh = np.concatenate(([True], np.diff(keys[order]) != 0)) if len(keys) else np.zeros(0, bool)
        first, which = order[fresh], np.empty(len(keys), np.int64)
        which[order] = np.cumsum(fresh) - 1
        each = keys[first]
        old, number = is_in(each, self.known), np.empty(len(each), np.int64)
        number[old] = self.number[np.searchsorted(self.known, each[old])]
        fresh = np.flatnonzero(~old)
        if len(fresh):
            raw, own = chunk.data.tobytes(), first[fresh]
            texts = [raw[a:b].decode() for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)]
            simple = np.fromiter((self.simple(t) is not None for t in texts), bool, len(texts))
            rest = np.flatnonzero(~simple)
            others = [texts[i].lower() if p else texts[i] for i, p in zip(rest.tolist(), plain[own[rest]].tolist(), strict=True)]
            letters = np.fromiter(map(str.isalpha, others), bool, len(others))
            coded = self._encode([texts[i] for i in np.flatnonzero(simple).tolist()], self._by_model)
            coded += self._encode([others[i] for i in np.flatnonzero(letters).tolist()], self._by_ends)
            coded += self._encode([others[i] for i in np.flatnonzero(~letters).tolist()], self._by_places)
            listed = np.concatenate((np.flatnonzero(simple), rest[letters], rest[~letters]))
            number[fresh[listed]] = len(self.table.size) + np.arange(len(listed))
            self.table.add(*(np.concatenate(x) for x in zip(*coded, strict=True)))
            # Both are in order.
            at = np.searchsorted(self.known, each[fresh])
            self.known, self.number = np.insert(self.known, at, each[fresh]), np.insert(self.number, at, number[fresh])
        which = number[which]
        sizes = np.concatenate(([0], np.cumsum(self.table.size[which])))
        return self.table.take(which), sizes[np.searchsorted(filled, 2 * found.first)]


def word_ends(tokenizer) -> np.ndarray:
    """Which ids end a piece of the pattern, as their token has the suffix of the model; none if it has no suffix."""
    known = tokenizer.get_vocab()
    ends = np.zeros(max(known.values(), default=0) + 1, bool)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    added = tokenizer.get_added_tokens_decoder().values()
    if suffix and all("<" in t.content for t in added):
        ends[[i for t, i in tokenizer.get_vocab(False).items() if t.endswith(suffix)]] = True
    return ends


def bare_tokenizer(tokenizer, ends: np.ndarray) -> tuple:
    """The model of a byte-level tokenizer over words between spaces, and the match of words that need no more.

    These are words of letters, ASCII or of two bytes, that come out the same by both, alone and repeated; without
    marked ids there are none.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    letters = [c for c in map(chr, range(ord("A"), 0x250)) if c.isalpha()] if ends.any() else []
    tried = [c * k for c in letters for k in (1, 3)]
    want = tokenizer.encode_batch_fast(tried, add_special_tokens=False)
    coded = [codecs.charmap_decode(t.lower().encode(), "strict", _BYTE_LETTERS)[0] for t in tried]
    got = bare.encode_batch_fast(coded, add_special_tokens=False)
    same = [w.ids == g.ids and ends[w.ids].sum() == 1 for w, g in zip(want, got, strict=True)]
    good = "".join(c for c, one, three in zip(letters, same[::2], same[1::2], strict=True) if one and three)
    return bare, re.compile(f"[{good}]+" if good else "(?!)").fullmatch


#: Bytes as the letters that stand for them in byte-level models; white space, which is only between words, as it is.
_BYTE_LETTERS = "".join(
    chr(b + 0xA2) if 0x7F <= b <= 0xA0 else chr(0x143) if b == 0xAD else chr(b) for b in range(256)
)
#: What may end a word as a piece of its own, and what may be before it: digits and letters, among them those of two bytes that begin so.
_STOPS, _ALNUM, _LATIN, _LATIN_LEAD = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool), 0xC3
_STOPS[np.frombuffer(b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~", np.uint8)] = True
_ALNUM[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def _parts(data: np.ndarray, found: W.Words) -> tuple[np.ndarray, ...]:
    """Begins, ends and keys of the bodies and stops of words, whether they are plain ASCII, and their places.

    Word ``i`` has places ``2 i`` and ``2 i + 1``; parts without characters are left out.
    """
    body, stops = found.end.copy(), _STOPS[data]
    if len(body):
        last = np.concatenate(([0], np.flatnonzero(~stops)))
        some = np.flatnonzero(stops[body - 1])
        at = last[np.searchsorted(last[1:], body[some])]
        good = _ALNUM[data[at]] | _LATIN[data[at]] & (data[at - 1] == _LATIN_LEAD)
        good &= at >= found.start[some]
        body[some[good]] = at[good] + 1
        held = np.searchsorted(found.start, np.flatnonzero(data == ord("<")), "right") - 1
        body[held] = found.end[held]
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 128) | (data == ord("<")), out=odd[1:])
    start, end = np.stack([found.start, body], 1).ravel(), np.stack([body, found.end], 1).ravel()
    filled = np.flatnonzero(end > start)
    start, end = start[filled], end[filled]
    plain = odd[end] == odd[start]
    keys = np.zeros(len(start), np.uint64)
    for flags, fold in ((plain, W.LOWER), (~plain, W.AS_IS)):
        some = np.flatnonzero(flags)
        keys[some] = W.hash_spans(data, start[some], end[some], fold)
    return start, end, keys, plain, filled


class _Table:
    """Runs of ids by number."""

    def __init__(self):
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(size) - size))
        self.flat, self.size = np.concatenate((self.flat, flat)), np.concatenate((self.size, size))

    def take(self, which: np.ndarray) -> np.ndarray:
        """The ids of the numbered runs, one after another."""
        size = self.size[which]
        shift = self.begin[which] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(size.sum())]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
    ids: bool = True,
) -> DataFrame:
    """``key, start, length, bucket, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids`` of every piece.

    ``bucket`` is the binary logarithm of the length. ``tokenizer_path`` is read by the driver.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    short_batches(docs.sparkSession)
    spec = Path(tokenizer_path).read_text(encoding="utf-8")
    if len(spec) > 64 << 20:
        raise ValueError("a tokenizer file of over 64 MB")

    from tokenizers import Tokenizer

    ends = word_ends(Tokenizer.from_str(spec))

    def cut(batches):
        encoder = WordIds(spec, ends)
        for batch in batches:
            for chunk in W.chunks(batch.column(1), CHUNK_BYTES):
                flat, begin = encoder.rows(chunk)
                rows, starts, lengths, sums, totals, values = [], [], [], [], [], []
                for r in range(len(begin) - 1):
                    own = np.append(flat[begin[r] : begin[r + 1]], np.uint32(end_id)).astype("<u4")
                    start = 0
                    for length in pieces(len(own), longest):
                        piece = own[start : start + length]
                        rows.append(r)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(piece))
                        totals.append(len(own))
                        if ids:
                            values.append(piece.astype(np.int32))
                        start += length
                keys = batch.column(0).slice(chunk.low, chunk.high - chunk.low).take(pa.array(rows, pa.int64()))
                columns = [keys, *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
                if ids:
                    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
                    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(flat)))
                names = ["key", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    cells = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = cells.schema["key"].dataType.simpleString()
    shape = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if ids else "")
    out = cells.mapInArrow(cut, shape)
    return out.select(
        F.col("key").alias(key), "start", "length", F.log2("length").cast("int").alias("bucket"), "ids_crc32",
        "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if ids else []),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Store sequences in one folder per length."""
    packed.write.partitionBy("bucket").parquet(path)
