import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from prepkit.operators import labels as ops
from prepkit.session import is_small, pin, small_side
from prepkit.sources.scan import declare_labels, declared_labels, label_element_type


def ids(df):
    return {r["label"]: r["id"] for r in df.collect()}


def test_vocab_is_sorted_and_ignores_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("é",), ("Z",)], "label string")
    assert ids(ops.build_label_vocab(df, "label")) == {"Z": 0, "a": 1, "b": 2, "é": 3}


def test_vocab_of_arrays_and_one_split(spark):
    df = spark.createDataFrame(
        [("train", ["x", "y"]), ("train", []), ("validation", ["z"]), ("train", None)], "split string, tags array<string>"
    )
    assert ids(ops.build_label_vocab(df, "tags")) == {"x": 0, "y": 1, "z": 2}
    assert ids(ops.build_label_vocab(df, "tags", split="train")) == {"x": 0, "y": 1}


def test_large_vocab_is_numbered_without_one_task(spark, monkeypatch):
    monkeypatch.setattr(ops, "is_small", lambda df: False)
    df = spark.range(300).select(F.concat(F.lit("l"), F.col("id")).alias("label"))
    got = ids(ops.build_label_vocab(df, "label"))
    assert got == {name: i for i, name in enumerate(sorted(got))}


def test_declared_order_wins_and_survives_storage(spark, tmp_path):
    df = spark.createDataFrame([(0, [1]), (1, [0])], "label int, many array<int>")
    named = declare_labels(declare_labels(df, "label", ["dog", "cat"]), "many", ["dog", "cat"])
    named.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert declared_labels(stored, "label") == ["dog", "cat"]
    assert label_element_type(stored, "many").simpleString() == "int"
    assert ids(ops.label_vocab(stored, "label")) == {"dog": 0, "cat": 1}
    raw = ops.encode_label_or_raw(stored, ops.label_vocab(stored, "label"), "label").collect()
    assert sorted(r["label_id"] for r in raw) == [0, 1]
    coded = ops.encode_label_array(stored, ops.label_vocab(stored, "many"), "many")
    assert sorted(r["label_ids"] for r in coded.collect()) == [[0], [1]]


def test_unknown_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, "q"), (3, None)], "k int, label string")
    vocab = spark.createDataFrame([("a", 0)], "label string, id int")
    with pytest.raises(PySparkException, match="label not in vocabulary: q"):
        ops.encode_label(df.where("k < 3"), vocab, "label").collect()
    assert [r["k"] for r in ops.encode_label(df, vocab, "label", on_unknown="drop").collect()] == [1]
    kept = ops.encode_label(df, vocab, "label", on_unknown="keep_null").orderBy("k").collect()
    assert [r["label_id"] for r in kept] == [0, None, None]
    with pytest.raises(ValueError):
        ops.encode_label(df, vocab, "label", on_unknown="ignore")


def test_unknown_labels_in_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "q"]), (3, [])], "k int, tags array<string>")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "label string, id int")
    with pytest.raises(PySparkException, match="label not in vocabulary: q"):
        ops.encode_label_array(df, vocab, "tags").collect()
    kept = ops.encode_label_array(df, vocab, "tags", on_unknown="keep_null").orderBy("k").collect()
    assert [r["label_ids"] for r in kept] == [[0, 1], [0, None], []]
    assert ops.encode_label_array(df, vocab, "tags", on_unknown="drop").count() == 2


def test_raw_labels_fall_back_per_row_not_per_batch(spark):
    df = spark.createDataFrame([("a",), ("7",), ("zzz",)], "label string")
    vocab = spark.createDataFrame([("a", 0)], "label string, id int")
    got = {r["label"]: r["label_id"] for r in ops.encode_label_or_raw(df, vocab, "label").collect()}
    assert got == {"a": 0, "7": 7, "zzz": None}


def test_decode_inverts_encode(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "label string")
    vocab = pin(ops.build_label_vocab(df, "label"))
    back = ops.decode_label(ops.encode_label(df, vocab, "label"), vocab, "label_id")
    assert back.where("label <> label_name").count() == 0 and back.count() == 4


def test_broadcast_only_below_the_limit(spark):
    vocab = pin(spark.range(1000).select(F.col("id").cast("string").alias("label"), F.col("id").cast("int")))
    assert is_small(vocab) and not is_small(vocab, 1000)
    rows = spark.range(100).select(F.col("id").cast("string").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = rows.join(small_side(vocab), F.col("x") == F.col("label"))
        large = rows.join(small_side(vocab, 1000), F.col("x") == F.col("label"))
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert small.count() == large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_label_is_encoded_whole(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("label"))
    vocab = pin(ops.build_label_vocab(df, "label"))
    assert ops.encode_label(df, vocab, "label").where("label_id is not null").count() == 3000


def test_indexed_labels_are_declared(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([("b",), ("a",), ("b",)], "name string")
    coded = StringIndexer(inputCol="name", outputCol="label").fit(df).transform(df)
    assert declared_labels(coded, "label") == ["b", "a"]
    got = ops.encode_label_or_raw(coded, ops.label_vocab(coded, "label"), "label")
    assert {(r["name"], r["label_id"]) for r in got.collect()} == {("b", 0), ("a", 1)}
