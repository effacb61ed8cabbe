"""Token counts beside sentencepiece, and pieces beside the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import as_dict, empty, table, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from prepkit.llm import packing, token_counts
from prepkit.llm import words as W

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
ENCODER = packing.WordIds(open(WORDS, encoding="utf-8").read())

ODD = [
    "", None, " ", "   ", "a", " a  b   c ", "\n\n\t", "x y z　", "ﬁ ½ é é 漢字かな😀👩‍👩‍👧", "▁▁a▁b",
    "<s> </s> <unk> <0x0A> <|endoftext|> <|startoftext|>hi", "<|ENDOFTEXT|>", "don't CAN'T I'll 's 'S", "\x00\x01\x7f\x85 ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50, "ab" * 3000, "1234567890 " * 300, "J̌ ́x ẞ İ ΑΣ ΑΣΑ",
    "http://a.b/c?d=e&f=%20#g", "힣가", "🏳️‍🌈" * 20, "the  " * 500, "= " * 40 + "==" * 40,
]


def samples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rng = random.Random(1)
    alphabet = "abcdeEINRST  \n'.,é漢😀-_0<|>▁"
    return ODD + [r["text"] for r in docs.collect()] + ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(300)]


def test_counts_are_those_of_the_library(spark):
    texts = samples(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = as_dict(token_counts.count_tokens(with_clashes(table(spark, texts)), MODEL))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(t or "")), repr(t)[:80]
        assert got[i]["n_bytes"] == len((t or "").encode())
    assert token_counts.count_tokens(empty(spark), MODEL).count() == 0


def test_counts_survive_forgetting(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    counter = token_counts.MergeCounter(open(MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "several different words, several of them again and again"
    assert counter.count(text) == len(library.encode(text)) and len(counter.known) <= 3


def test_lengths_of_pieces():
    assert packing.pieces(0) == []
    assert packing.pieces(1) == [1]
    assert packing.pieces(4096 + 7, 2048) == [2048, 2048, 4, 2, 1]
    assert all(sum(packing.pieces(n, 64)) == n for n in range(300))


@pytest.mark.parametrize("longest", [2048, 16])
def test_pieces_give_the_ids_back(spark, longest):
    texts = samples(spark)
    library = Tokenizer.from_file(WORDS)
    packed = packing.pack(with_clashes(table(spark, texts)), WORDS, longest=longest).collect()
    found = {}
    for r in packed:
        assert len(r["ids"]) == r["length"] == 1 << r["bucket"] <= longest
        assert r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        found.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in packed}) == len(packed)
    for i, t in enumerate(texts):
        own = sorted(found[i], key=lambda r: r["start"])
        want = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert [x for r in own for x in r["ids"]] == want, repr(t)[:80]
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert {r["doc_tokens"] for r in own} == {len(want)}


def test_pieces_survive_forgetting(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 2)
    monkeypatch.setattr(packing, "AT_ONCE", 3)
    library = Tokenizer.from_file(WORDS)
    encoder = packing.WordIds(open(WORDS, encoding="utf-8").read())
    texts = ["one two three four one", "five", "", "one five, six. Seven eight... <|endoftext|>, nine ten!"]
    for _ in range(2):
        for chunk in W.chunks(pa.array(texts), 30):
            flat, begin = encoder.rows(chunk)
            for r, text in enumerate(texts[chunk.low : chunk.high]):
                assert flat[begin[r] : begin[r + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


STOPS = st.text(alphabet="aB1é'.,;!?-<|> \n\u0301", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(STOPS, max_size=4))
def test_words_and_stops_are_cut_where_the_library_cuts(texts):
    for chunk in W.chunks(pa.array(texts, pa.string())):
        flat, begin = ENCODER.rows(chunk)
        for r, text in enumerate(texts):
            assert flat[begin[r] : begin[r + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_no_documents_and_wrong_length(spark):
    assert packing.pack(empty(spark), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), WORDS, longest=1000)


def test_buckets_are_folders_of_one_length(spark, tmp_path):
    packing.write_buckets(packing.pack(table(spark, ["a b c d e", "f g h", None]), WORDS), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert all(r["length"] == 2 ** r["bucket"] for r in back.collect())


def test_words_of_letters_are_encoded_without_places(monkeypatch):
    class NoPlaces:
        def __getattr__(self, name):
            assert name != "encode", "places of ids were asked for"
            return getattr(LIBRARY, name)

    encoder = packing.WordIds(open(WORDS, encoding="utf-8").read())
    encoder.tokenizer = NoPlaces()
    texts = ["Several plain words and \u00e9t\u00e9 \u6f22\u5b57", None, "unbelievably longwordsthatsplit into pieces"]
    for chunk in W.chunks(pa.array(texts)):
        flat, begin = encoder.rows(chunk)
        for r, text in enumerate(texts):
            assert flat[begin[r] : begin[r + 1]].tolist() == LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_letters_that_come_apart_in_lower_case():
    texts = ["\u0130stanbul \u0130 one", "abc \u0130", "\u212a \u1e9e J\u030c"]
    for chunk in W.chunks(pa.array(texts)):
        flat, begin = ENCODER.rows(chunk)
        for r, text in enumerate(texts):
            assert flat[begin[r] : begin[r + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_words_of_latin_letters_need_the_model_only():
    class Refused:
        def __getattr__(self, name):
            raise AssertionError(f"{name} of the whole tokenizer was asked for")

    encoder = packing.WordIds(open(WORDS, encoding="utf-8").read())
    encoder.tokenizer = Refused()
    texts = ["Straße ÉTÉ unbelievablylongwords łódź ǅ ª", None, "resteé"]
    for chunk in W.chunks(pa.array(texts)):
        flat, begin = encoder.rows(chunk)
        for r, text in enumerate(texts):
            assert flat[begin[r] : begin[r + 1]].tolist() == LIBRARY.encode(text or "", add_special_tokens=False).ids
    assert encoder.simple("\u00e9") and not any(map(encoder.simple, ["\u0130", "e\u0301", "a1"]))


PIECES = ["a", "B", "1", "é", "×", "ß", "İ", "́", "$$$", "'s", "'", "&&&", "|", ">", "-", "<|endoftext|>", "<", " ", "\n", "\x1c"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=4))
def test_punctuation_is_cut_off_where_the_library_cuts(texts):
    for chunk in W.chunks(pa.array(texts, pa.string())):
        flat, begin = ENCODER.rows(chunk)
        for r, text in enumerate(texts):
            assert flat[begin[r] : begin[r + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_ends_of_any_punctuation_are_parts_of_their_own():
    [chunk] = W.chunks(pa.array(["word$$$ word&&& été### word $$$ <|endoftext|> a|> ×$"]))
    start, end, *_ = packing._parts(chunk.data, W.find_words(chunk, hashed=False))
    assert [chunk.text(a, b) for a, b in zip(start.tolist(), end.tolist(), strict=True)] == [
        "word", "$$$", "word", "&&&", "été", "###", "word", "$$$", "<|endoftext|>", "a", "|>", "×$"
    ]
