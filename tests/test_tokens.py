import random

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from prepkit.functions import lookup
from prepkit.functions.arrow import small_parts
from prepkit.functions.text import to_text, words
from prepkit.operators import subwords
from prepkit.operators import tokens as ops
from prepkit.operators.labels import label_vocab
from prepkit.operators.tokens import END, START, UNKNOWN, EncoderSpec
from prepkit.session import pin


def rows_of(spark, values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"k int, text {kind}")


def vocab_of(spark, *tokens):
    return spark.createDataFrame([(t, i + 4) for i, t in enumerate(tokens)], "token string, id int")


def column(df, name):
    return [r[name] for r in df.orderBy("k").collect()]


def test_vocab_orders_by_count_then_token(spark):
    df = rows_of(spark, ["b a b", "c a", None, ""])
    got = [(r["token"], r["id"]) for r in ops.build_vocab(df, "text", 3).orderBy("id").collect()]
    assert got == [("a", 4), ("b", 5), ("c", 6)]
    assert [r["token"] for r in ops.build_vocab(df, "text", 1).collect()] == ["a"]
    assert ops.vocab_size(ops.build_vocab(df, "text", 3)).first()["vocab_size"] == 7


def test_words_encode(spark):
    df = rows_of(spark, ["a  b\tq\nb ", "", None, "   "])
    coded = ops.encode(df, "text", EncoderSpec(), vocab_of(spark, "a", "b"), word_ids="w")
    assert column(coded, "input_ids") == [[4, 5, UNKNOWN, 5], [], None, []]
    assert column(coded, "w") == [[0, 1, 2, 3], [], None, []]


def test_truncation_counts_special_tokens(spark):
    df = rows_of(spark, ["a b a b", "a"])
    vocab = vocab_of(spark, "a", "b")
    assert column(ops.encode(df, "text", EncoderSpec(max_length=3), vocab), "input_ids") == [[4, 5, 4], [4]]
    framed = ops.encode(df, "text", EncoderSpec(max_length=3, specials=True), vocab, word_ids="w")
    assert column(framed, "input_ids") == [[START, 4, END], [START, 4, END]]
    assert column(framed, "w") == [[None, 0, None], [None, 0, None]]


def test_pieces(spark):
    spec = EncoderSpec("chunk", width=2)
    vocab = vocab_of(spark, "ab", "c", "é😀")
    texts = ops.encode(rows_of(spark, ["abc c é😀ab"]), "text", spec, vocab, word_ids="w")
    assert column(texts, "input_ids") == [[4, 5, 5, 6, 4]]
    assert column(texts, "w") == [[0, 0, 1, 2, 2]]
    listed = rows_of(spark, [["abc", "", "c", None, "ab"], []], "array<string>")
    arrays = ops.encode(listed, "text", spec, vocab, word_ids="w")
    assert column(arrays, "input_ids") == [[4, 5, 5, 4], []]
    assert column(arrays, "w") == [[0, 0, 2, 4], []]
    cut = ops.encode(listed, "text", EncoderSpec("chunk", width=2, max_length=3), vocab, word_ids="w")
    assert column(cut, "input_ids") == [[4, 5, 5], []] and column(cut, "w") == [[0, 0, 2], []]


def test_word_longer_than_the_limit(spark):
    coded = ops.encode(
        rows_of(spark, ["abcdefgh x"]), "text", EncoderSpec("chunk", width=2, max_length=3), vocab_of(spark, "ab", "cd", "ef"), word_ids="w"
    )
    assert column(coded, "input_ids") == [[4, 5, 6]] and column(coded, "w") == [[0, 0, 0]]


def test_long_vocabularies_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", 1)
    df = rows_of(spark, ["a b q", "", None, "b b"])
    vocab = vocab_of(spark, "a", "b")
    coded = ops.encode(df, "text", EncoderSpec(), vocab)
    assert column(coded, "input_ids") == [[4, 5, UNKNOWN], [], None, [5, 5]]


@pytest.mark.parametrize("limit", [100_000, 1])
def test_lookup_is_one_whatever_the_size(spark, monkeypatch, limit):
    """Shared and missing keys, missing lists and missing words, by literal and by join."""
    monkeypatch.setattr(lookup, "LITERAL_ROWS", limit)
    rows = [(1, ["a", "q"]), (1, ["b", "a"]), (1, ["b", "a"]), (None, ["a", None]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "k int, t array<string>")
    found = lookup.map_array(df, "t", vocab_of(spark, "a", "b"), "token", "id", "ids", default=1)
    got = sorted(((r["k"], r["t"], r["ids"]) for r in found.collect()), key=repr)
    want = [(1, ["a", "q"], [4, 1]), (1, ["b", "a"], [5, 4]), (1, ["b", "a"], [5, 4]), (None, ["a", None], [4, 1]), (2, None, None), (3, [], [])]
    assert got == sorted(want, key=repr)


def test_hot_token_is_spread(spark):
    df = spark.range(400).select(F.col("id").cast("int").alias("k"), F.array_repeat(F.lit("the"), 5).alias("t"))
    got = lookup.packed_lookup(df, "t", vocab_of(spark, "the"), "token", "id", "ids")
    assert got.where(F.col("ids") == F.array_repeat(F.lit(4), 5)).count() == 400


def test_json_equals_word(spark):
    texts = ["a b  c", "q\tq a", "", None, "c" * 50]
    df = rows_of(spark, texts)
    vocab = ops.build_vocab(df, "text", 10)
    asset = ops.json_asset(vocab)
    for specials in (False, True):
        for limit in (None, 4):
            word = ops.encode(df, "text", EncoderSpec(max_length=limit, specials=specials), vocab, word_ids="w")
            spec = EncoderSpec("json", max_length=limit, specials=specials, asset=asset)
            other = ops.encode(df, "text", spec, word_ids="w")
            assert column(word, "input_ids") == column(other, "input_ids")
    listed = df.select("k", words("text").alias("text"))
    spec = EncoderSpec("json", specials=True, asset=asset)
    word = ops.encode(listed, "text", EncoderSpec(specials=True), vocab, word_ids="w")
    other = ops.encode(listed, "text", spec, word_ids="w")
    assert column(word, "input_ids") == column(other, "input_ids") and column(word, "w") == column(other, "w")


def test_pad_falls_back_to_end(spark):
    asset = ops.json_asset(vocab_of(spark, "a"))
    assert ops.json_spec(asset, pad_token="<pad>", end_token="</s>").padding == 0
    assert ops.json_spec(asset, end_token="</s>").padding == END
    for missing in ({}, {"pad_token": "<none>"}):
        with pytest.raises(ValueError):
            ops.json_spec(asset, **missing)
    assert EncoderSpec().padding == 0
    assert EncoderSpec(pad_id=None).padding == END
    for bad in ({"kind": "bpe"}, {"kind": "chunk"}, {"kind": "json"}, {"width": 3}):
        with pytest.raises(ValueError):
            EncoderSpec(**bad)


def test_align(spark):
    df = spark.createDataFrame(
        [(0, [None, 0, 0, 1, None], [7, 8]), (1, [], []), (2, [0, 1, None, 1], [5, 6]), (3, [1, 1], [5, 6])],
        "k int, word_ids array<int>, label_ids array<int>",
    )
    assert column(ops.align_labels(df), "labels") == [
        [-100, 7, -100, 8, -100], [], [5, 6, -100, 6], [6, -100],
    ]
    short = spark.createDataFrame([(0, [0, 1], [5])], df.schema)
    with pytest.raises(PySparkException):
        ops.align_labels(short).collect()


def by_hand(tokens, width, limit):
    pieces = [(w[i : i + width], n) for n, w in enumerate(tokens) for i in range(0, len(w), width)][:limit]
    seen, labels = None, []
    for _, n in pieces:
        labels.append(-100 if n == seen else n * 10)
        seen = n
    return [p for p, _ in pieces], labels


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.text("abcdeé1", max_size=9), max_size=12), min_size=1, max_size=8),
    st.integers(1, 5),
    st.integers(1, 20),
)
def test_pieces_and_alignment_match_plain_python(spark, data, width, limit):
    df = spark.createDataFrame(
        [(i, t, [n * 10 for n in range(len(t))]) for i, t in enumerate(data)],
        "k int, text array<string>, label_ids array<int>",
    ).repartition(random.choice([1, 3]))
    vocab = ops.build_vocab(df, "text", 1000, width)
    known = {r["token"]: r["id"] for r in vocab.collect()}
    coded = ops.encode(df, "text", EncoderSpec("chunk", width=width, max_length=limit), vocab, word_ids="word_ids")
    for row in ops.align_labels(coded).collect():
        parts, labels = by_hand(data[row["k"]], width, limit)
        assert row["input_ids"] == [known[p] for p in parts]
        assert row["labels"] == labels


@pytest.mark.parametrize(
    "value",
    [
        ["plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "tab\tline\nret\r", "nul\x00\x7f\xa0\xad", "é😀 ​"],
        [],
        [None, ""],
    ],
)
def test_text_of_lists_is_python_repr(spark, value):
    df = spark.createDataFrame([(value,)], "v array<string>")
    assert df.select(to_text(F.col("v"), df.schema["v"].dataType).alias("t")).first()["t"] == str(value)


def test_text_of_other_cells(spark):
    df = spark.createDataFrame([("it's", None, [[1, 2], []], [True, None])], "s string, n string, i array<array<int>>, b array<boolean>")
    row = df.select(*[to_text(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).first()
    assert list(row) == ["it's", "None", "[[1, 2], []]", "[True, None]"]
    joined = df.select(to_text(F.array(F.lit("a"), F.lit("b")), df.select(F.array("s").alias("x")).schema["x"].dataType, "join"))
    assert joined.first()[0] == "a, b"


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_public_tokenizer_batches(spark, tmp_path, file):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from prepkit.config import LanguageModelJob, TokenClassJob
    from prepkit.plans.language_model import lm_batches
    from prepkit.plans.token_class import token_class_batches

    path = public.path(file)
    tokenizer = Tokenizer.from_file(path)
    end = tokenizer.token_to_id("<|endoftext|>")
    texts = ["A short text.", "Wörter über Wörter, and it's longer", "x", "unbelievable tokenization of 12345 things"] * 3
    df = spark.createDataFrame([(i, "train", t) for i, t in enumerate(texts)], "id int, split string, text string")
    settings = dict(encoder="json", tokenizer_name=str(path), eos_token="<|endoftext|>", per_device_train_batch_size=2, per_device_eval_batch_size=2, shards=2)
    job = LanguageModelJob(text_column_name="text", max_tokens_length=6, **settings)
    for row in lm_batches(df, job).collect():
        ids = tokenizer.encode(texts[row["id"]]).ids[:6]
        assert row["input_ids"][: len(ids)] == ids and row["tokens_input_length"] == len(ids)
        assert set(row["input_ids"][len(ids) :]) <= {end} and row["labels"] == row["input_ids"]
        assert sum(row["attention_mask"]) == len(ids)
    words_df = df.withColumn("tokens", words("text")).withColumn("tags", F.transform("tokens", lambda w: F.length(w).cast("string")))
    job = TokenClassJob(text_column_name="tokens", label_column_name="tags", **settings)
    ids_of = {r["label"]: r["id"] for r in label_vocab(words_df, "tags").collect()}
    for row in token_class_batches(words_df, job).collect():
        listed = texts[row["id"]].split()
        coded = tokenizer.encode(listed, is_pretokenized=True)
        want, last = [], None
        for w in coded.word_ids:
            want.append(-100 if w is None or w == last else ids_of[str(len(listed[w]))])
            last = w
        assert row["input_ids"][: len(coded.ids)] == coded.ids
        assert row["labels"] == want + [-100] * (len(row["input_ids"]) - len(want))


def test_very_long_tokens_are_joined(spark):
    long = "z" * 60_000
    df = rows_of(spark, [f"a {long} {long}x"])
    coded = ops.encode(df, "text", EncoderSpec(), vocab_of(spark, "a", long))
    assert column(coded, "input_ids") == [[4, 5, UNKNOWN]]


def test_piece_counts_weigh_words(spark):
    df = rows_of(spark, ["abab ab abab", "cab"])
    got = {r["token"]: r["count"] for r in ops.count_tokens(df, "text", 2).collect()}
    assert got == {"ab": 5, "ca": 1, "b": 1}


def spelled(word, vocab, longest):
    """Greedy longest match in plain Python."""
    if len(word) > 100:
        return [UNKNOWN]
    ids, at = [], 0
    while at < len(word):
        for n in range(min(longest, len(word) - at), 0, -1):
            piece = ("##" if at else "") + word[at : at + n]
            if piece in vocab:
                ids.append(vocab[piece])
                at += n
                break
        else:
            return [UNKNOWN]
    return ids


@pytest.mark.parametrize("limit", [100_000, 1])
def test_subwords_are_the_longest_matches(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", limit)
    rng = random.Random(limit)
    texts = [" ".join("".join(rng.choices("abcé", k=rng.randrange(1, 9))) for _ in range(rng.randrange(12))) for _ in range(60)]
    texts += [None, "", "abc" * 40, "q", "##ab ab##", "a" * 100, "a" * 101]
    df = rows_of(spark, texts)
    vocab = ops.subword_vocab(df, "text", 60, 4)
    held = {r["token"]: r["id"] for r in vocab.collect()}
    assert len(held) == 60 and sorted(held.values()) == list(range(4, 64))
    held.pop("b", None)
    kept = vocab.where("token <> 'b'")
    coded = ops.encode(df, "text", EncoderSpec("subword", width=4), kept, word_ids="w")
    for text, ids, at in zip(texts, column(coded, "input_ids"), column(coded, "w"), strict=True):
        want = None if text is None else [spelled(w, held, 4) for w in text.split()]
        assert ids == (None if want is None else [i for p in want for i in p])
        assert at == (None if want is None else [k for k, p in enumerate(want) for _ in p])


def test_subwords_of_word_lists_and_limits(spark):
    vocab = vocab_of(spark, "a", "b", "##b", "##c", "ab")
    df = rows_of(spark, [["abc", "", None, "x", "b"], [], None], "array<string>")
    coded = ops.encode(df, "text", EncoderSpec("subword", width=2), vocab, word_ids="w")
    assert column(coded, "input_ids") == [[8, 7, UNKNOWN, 5], [], None]
    assert column(coded, "w") == [[0, 0, 3, 4], [], None]
    cut = ops.encode(df, "text", EncoderSpec("subword", width=2, max_length=4, specials=True), vocab, word_ids="w")
    assert column(cut, "input_ids") == [[START, 8, 7, END], [START, END], None]
    assert column(cut, "w") == [[None, 0, 0, None], [None, None], None]


def test_single_characters_come_first_in_a_subword_vocabulary(spark):
    df = rows_of(spark, ["aab aab aab c"])
    got = {r["token"]: r["id"] for r in ops.subword_vocab(df, "text", 6, 3).collect()}
    assert sorted(got, key=got.get) == ["##a", "##b", "a", "c", "##ab", "aa"]


def test_subwords_plan_has_no_python(spark, monkeypatch):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", 1)
    df = rows_of(spark, ["ab abc", "c"])
    coded = ops.encode(df, "text", EncoderSpec("subword", width=2), vocab_of(spark, "a", "##b", "##c", "c"))
    assert not any(w in coded._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("limit", [100_000, 1])
def test_an_entry_held_twice_is_refused(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", limit)
    df = spark.createDataFrame([(1, ["a", "b"])], "k int, t array<string>")
    with pytest.raises((ValueError, PySparkException)):
        lookup.map_array(df, "t", vocab_of(spark, "a", "b", "a"), "token", "id", "ids").collect()


def test_long_dictionaries_shuffle_rows_and_distinct_tokens_only(spark):
    """Above the step that lists tokens, an aggregate makes them distinct before anything is shuffled."""
    df = spark.range(2000).select("id", F.array_repeat(F.lit("the"), 50).alias("t"))
    got = lookup.packed_lookup(df, "t", vocab_of(spark, "the", "a"), "token", "id", "ids")
    lines = got._jdf.queryExecution().sparkPlan().toString().splitlines()
    names = [line.lstrip(" :+-*").split("(")[0].split(" ")[0] for line in lines]
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    place = names.index("Generate")
    assert names.count("Generate") == 1
    above, at = [], depth[place]
    for k in range(place - 1, -1, -1):
        if depth[k] < at:
            above.append(names[k])
            at = depth[k]
    assert "HashAggregate" in above
    first = above.index("HashAggregate")
    assert not {"Exchange", "RepartitionByExpression", "SortMergeJoin"} & set(above[:first])
    assert got.where("ids = array_repeat(4, 50)").count() == 2000


def test_copies_of_an_entry_follow_the_chunks(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CHUNKS_PER_COPY", 2)
    df = spark.range(1500).select("id", F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id") % 7)).alias("t"))
    got = lookup.packed_lookup(df, "t", vocab_of(spark, "the", "w3"), "token", "id", "ids").collect()
    assert len(got) == 1500 and all(r["ids"] == [4, 5 if r["id"] % 7 == 3 else None] for r in got)


def test_full_vocabulary_is_numbered_as_the_capped_one(spark):
    df = rows_of(spark, ["b a b", "c a d e", None, ""])
    full = {r["token"]: r["id"] for r in ops.build_full_vocab(df, "text").collect()}
    assert full == {r["token"]: r["id"] for r in ops.build_vocab(df, "text", 100).collect()}


def test_json_encodes_small_parts_of_a_batch():
    """Whole results in order, while the encodings of a bounded number of bytes are held at a time."""
    vocab = {"<pad>": 0, "<unk>": 1, "a": 4}
    asset = Tokenizer(models.WordLevel(vocab, unk_token="<unk>"))
    asset.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    spec = EncoderSpec("json", asset=asset.to_str())
    texts = [None if i % 7 == 3 else "a b " * (i % 500) for i in range(4000)]
    for given in (pa.array(texts), pa.array([t and t.split() for t in texts], pa.list_(pa.string()))):
        parts = list(ops._json_codes(spec, iter([given])))
        assert len(parts) >= given.nbytes // ops.JSON_BYTES > 1
        got = [r for part in parts for r in part.to_pylist()]
        want = [None if t is None else [4, 1] * (i % 500) for i, t in enumerate(texts)]
        assert [r["input_ids"] for r in got] == (want if given.type == pa.string() else [w if w else (None if t is None else []) for w, t in zip(want, texts)])


def test_a_row_of_any_size_is_a_part():
    parts = list(small_parts(pa.array(["x" * 5000, "y", None, "z" * 5000, "", "q"]), 1000))
    assert [x for p in parts for x in p.to_pylist()] == ["x" * 5000, "y", None, "z" * 5000, "", "q"]
    assert all(len(p) == 1 or p.nbytes <= 1000 for p in parts)


def test_tokens_are_stored_as_places_in_their_chunk(spark, monkeypatch):
    """The rows of an Arrow batch make one chunk, so a token of all rows meets the dictionary once for them."""
    stored = []
    monkeypatch.setattr(lookup, "pin", lambda df, name: stored.append(pin(df, name)) or stored[-1])
    words = F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id") % 7), F.lit(None))
    df = spark.range(0, 3000, 1, 2).select("id", F.when(F.col("id") % 5 > 0, words).alias("t"))
    got = lookup.packed_lookup(df, "t", vocab_of(spark, "the", "w3"), "token", "id", "ids", keep=False)
    assert got.columns == ["id", "ids"]
    want = {i: [4, 5 if i % 7 == 3 else None, None] if i % 5 else None for i in range(3000)}
    assert {r["id"]: r["ids"] for r in got.collect()} == want
    assert stored[0].agg(F.sum(F.size("entries"))).first()[0] <= 6 * 8


@pytest.mark.parametrize("limit", [100_000, 1])
def test_spelling_by_literal_and_by_join(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "LITERAL_ROWS", limit)
    vocab = vocab_of(spark, "a", "ab", "##b", "##bc", "##c", "x", "é", "##漢")
    spelled = {"abc": [5, 8], "a": [4], "abbcb": [5, 7, 6], "q": [1], "xq": [1], "": [], "é漢": [10, 11], "a" + "b" * 99: [5] + [6] * 98, "a" + "b" * 100: [1]}
    df = spark.createDataFrame([(w,) for w in [*spelled, None]], "w string")
    got = {r["word"]: r["ids"] for r in subwords.spell(df, "w", vocab, 3, 1).collect()}
    assert got == spelled


def test_short_vocabularies_spell_words_without_a_shuffle(spark):
    df = spark.range(9).select(F.concat(F.lit("a"), F.col("id")).alias("w"))
    plan = subwords.spell(df, "w", vocab_of(spark, "a", "##1"), 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
