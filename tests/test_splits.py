import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from prepkit.operators import positions, selection, splits
from prepkit.operators.positions import global_position
from prepkit.operators.splits import boundary_hash, head_n, head_per_split, split_exact, split_hash
from prepkit.sources import scan


def digest(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 2, 7, 20, 333])
@pytest.mark.parametrize("partitions", [1, 5])
def test_exact_sizes(spark, n, partitions):
    df = spark.range(n).repartition(partitions)
    got = {r["id"] for r in split_exact(df, "id").where("split = 'validation'").collect()}
    want = sorted(range(n), key=digest)[: math.ceil(0.15 * n)]
    assert got == set(want)


def test_exact_narrows_in_steps(spark, monkeypatch):
    monkeypatch.setattr(splits, "FEW_ROWS", 0)
    df = spark.range(500)
    assert boundary_hash(df, "id", 42, 0.5) == sorted(map(digest, range(500)))[249]


def test_exact_extremes(spark):
    df = spark.range(10)
    assert split_exact(df, "id", 0.0).where("split = 'validation'").count() == 0
    assert split_exact(df, "id", 1.0).where("split = 'train'").count() == 0
    assert split_exact(df.limit(0), "id").count() == 0


def test_exact_does_not_shuffle_rows(spark):
    plan = split_exact(spark.range(100), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_copies_of_a_hot_key_stay_together(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, F.lit(-1)).otherwise(F.col("id")).alias("id"))
    sides = split_exact(df, "id").groupBy("id").agg(F.countDistinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_seed_changes_the_cut(spark):
    df = spark.range(200)
    first = {r["id"] for r in split_exact(df, "id", seed=1).where("split = 'validation'").collect()}
    second = {r["id"] for r in split_exact(df, "id", seed=2).where("split = 'validation'").collect()}
    assert len(first) == len(second) == 30 and first != second


def test_hash_split_is_close(spark):
    n = split_hash(spark.range(10_000), "id").where("split = 'validation'").count()
    assert 1350 < n < 1650


def test_head_clamps_and_keeps_order(spark):
    df = spark.range(20).repartition(6)
    assert [r["id"] for r in head_n(df, "id", 5).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    assert head_n(df, "id", 100).count() == 20
    assert head_n(df, "id", None).count() == 20


def test_head_of_shared_and_missing_keys(spark, monkeypatch):
    """Exactly n rows at any number of buckets, missing keys first."""
    rows = [(None, "x"), (None, "y"), *((i // 3, f"t{i}") for i in range(90))]
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    for size in (250_000, 10):
        monkeypatch.setattr(positions, "RANGE_ROWS", size)
        monkeypatch.setattr(selection, "FEW", size)
        for n in (0, 1, 2, 5, 50, 92, 100):
            got = sorted(((-1 if r["k"] is None else r["k"]) for r in head_n(df, "k", n).collect()))
            assert got == sorted(-1 if k is None else k for k, _ in rows)[:n]
            assert head_n(df, ["k", "t"], n).count() == min(n, 92)
        placed = global_position(df, "k").collect()
        assert sorted(r["position"] for r in placed) == list(range(1, 93))


def test_positions_keep_rows_without_a_group(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "a")], "k int, split string")
    got = {(r["k"], r["position"]) for r in global_position(df, "k", by="split").collect()}
    assert got == {(1, 1), (4, 2), (2, 1), (3, 2)}


def test_head_of_many_rows(spark):
    df = spark.range(50).repartition(5)
    assert {r["id"] for r in head_n(df, "id", 7).collect()} == set(range(7))
    names = df.select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("name"))
    assert {r["name"] for r in head_n(names, "name", 4).collect()} == {"n000", "n001", "n002", "n003"}


def test_head_per_split_keeps_rows_without_a_split(spark):
    df = spark.createDataFrame([(1, "train"), (2, None), (3, "train")], "id int, split string")
    assert {r["id"] for r in head_per_split(df, "id", {"train": 1}).collect()} == {1, 2}


def test_head_per_split(spark):
    df = spark.range(30).withColumn("split", F.when(F.col("id") % 3 == 0, "validation").otherwise("train"))
    got = head_per_split(df, "id", {"train": 4, "validation": None}).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 4, "validation": 10}


@pytest.mark.parametrize("partitions", [1, 4, 16])
@pytest.mark.parametrize("seed", [None, 7])
def test_positions(spark, partitions, seed):
    df = spark.range(200).select((F.col("id") * 3).alias("id")).repartition(partitions)
    df = df.withColumn("split", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    rows = global_position(df, "id", seed, "split").collect()
    for split in ("a", "b"):
        ids = [r["id"] for r in sorted((r for r in rows if r["split"] == split), key=lambda r: r["position"])]
        order = (lambda k: digest(k, seed)) if seed is not None else (lambda k: k)
        assert ids == sorted(ids, key=order)
        assert sorted(r["position"] for r in rows if r["split"] == split) == list(range(1, len(ids) + 1))


def test_positions_over_many_ranges(spark, monkeypatch):
    from prepkit.operators import positions

    monkeypatch.setattr(positions, "RANGE_ROWS", 10)
    monkeypatch.setattr(positions, "SAMPLE_PER_BUCKET", 2)
    skewed = spark.range(500).select(F.when(F.col("id") < 400, F.col("id")).otherwise(F.col("id") * 10**9).alias("id"))
    rows = global_position(skewed.repartition(7), "id").orderBy("position").collect()
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)
    assert [r["position"] for r in rows] == list(range(1, 501))


def test_positions_of_text_keys(spark):
    df = spark.range(100).select(F.md5(F.col("id").cast("string")).alias("name"))
    rows = global_position(df, "name").orderBy("position").collect()
    assert [r["name"] for r in rows] == sorted(r["name"] for r in rows)


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def test_keys_are_found_by_narrowing(spark, monkeypatch):
    """Two columns with missing values, many ties, few bounds a pass, and passes until one key is left."""
    rng = random.Random(3)
    rows = [(rng.choice((None, 1, 2, 2, 2, 7)), rng.choice((None, "a", "b", "\u00e9"))) for _ in range(150)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(3)
    want = ordered(rows)
    monkeypatch.setattr(selection, "BOUNDS", 3)
    monkeypatch.setattr(selection, "FEW", 0)
    for n in (1, 2, 40, 75, 149, 150):
        assert tuple(selection.key_at(df, ["k", "t"], n)) == want[n - 1]
    assert selection.key_at(df, ["k", "t"], 151) is None and selection.key_at(df, ["k", "t"], 0) is None
    assert selection.key_at(df.limit(0), "k", 1) is None


def test_rows_between_split_a_tie_the_same_way(spark):
    rows = [(i // 10, f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t string")
    whole = {r["t"] for r in df.collect()}
    cuts = [0, 3, 7, 25, 25, 48, 60]
    parts = []
    for parts_count in (1, 5):
        shuffled = df.repartition(parts_count)
        got = [{r["t"] for r in selection.rows_between(shuffled, "k", a, b).collect()} for a, b in zip(cuts, cuts[1:], strict=False)]
        assert [len(g) for g in got] == [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
        assert set().union(*got) == whole
        parts.append(got)
    assert parts[0] == parts[1]
    assert selection.rows_between(df, "k", 55, None).count() == 5 and selection.rows_between(df, "k", 60, None).count() == 0
    assert selection.rows_between(df, "k", 70, 80).count() == 0 and selection.rows_between(df, "k", 5, 4).count() == 0


def test_head_shuffles_counts_only(spark):
    """The key of row n comes from one grouped pass a time; the rows are filtered where they lie."""
    df = spark.range(5000).repartition(4).withColumn("text", F.repeat(F.lit("x"), 100))
    plan = head_n(df, "id", 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan
    assert head_n(df, "id", 100).agg(F.max("id")).first()[0] == 99


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("train", range(20)), ("train[:10%]", range(2)), ("train[15:]", range(15, 20)), ("train[-3:]", range(17, 20)),
        ("train[ 2 : 50% ]", range(2, 10)), ("train[:]", range(20)), ("train[5:5]", ()), ("train[30:40]", ()),
        ("train[:3]+train[-2:]", (0, 1, 2, 18, 19)), ("train[:-90%] + test", (0, 1, 100, 101)),
    ],
)
def test_slices(spark, tmp_path, text, want):
    spark.range(20).withColumn("split", F.lit("train")).unionByName(
        spark.range(100, 102).withColumn("split", F.lit("test"))
    ).write.partitionBy("split").parquet(str(tmp_path / "d"))
    got = scan.scan_slice(spark, str(tmp_path / "d"), text, "id").collect()
    assert sorted(r["id"] for r in got) == list(want)


@pytest.mark.parametrize("text", ["train[1]", "train[1:2", "[1:2]", "train[a:b]", "train[1:2]x", ""])
def test_bad_slices_are_refused(spark, tmp_path, text):
    with pytest.raises(ValueError, match="slice"):
        scan.scan_slice(spark, str(tmp_path), text, "id")
