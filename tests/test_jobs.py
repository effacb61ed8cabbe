import base64
import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.__main__ import main
from prepkit.config import (
    CaptionJob,
    ImageClassJob,
    Job,
    LanguageModelJob,
    TextClassJob,
    TokenClassJob,
    job_from_dict,
    parse_job,
)
from prepkit.functions.png import encode_png
from prepkit.operators.checks import (
    assert_features,
    keep_complete,
    missing_features,
    require_columns,
    require_features,
    split_rejects,
)
from prepkit.plans.common import load_splits
from prepkit.plans.images import image_class_batches
from prepkit.plans.jobs import run_job
from prepkit.plans.language_model import lm_batches
from prepkit.plans.text_class import text_class_batches
from prepkit.session import file_exists, new_path, pin, shared_dir, temporary_tables
from prepkit.sinks import store
from prepkit.sources.scan import scan_split, union_splits


def test_settings_from_json_and_flags(tmp_path):
    path = tmp_path / "job.json"
    settings = {
        "model_name_or_path": "some/model", "model_type": "seq2seq", "dataset_name": "d", "source_column_name": "a",
        "target_column_name": "b", "max_tokens_length": 64, "learning_rate": 5e-5, "fp16": True, "max_train_samples": 3,
    }
    path.write_text(json.dumps(settings))
    job = parse_job(LanguageModelJob, [str(path)])
    assert (job.model_type, job.max_tokens_length, job.trainer) == (
        "seq2seq", 64, {"model_name_or_path": "some/model", "learning_rate": 5e-5, "fp16": True}
    )
    assert job.limits() == {"train": 3, "validation": None}
    flags = parse_job(
        TextClassJob, ["--dataset_name_or_path", "d", "--text_column_name", "t", "--do_eval", "false", "--max_train_samples", "5"]
    )
    assert (flags.dataset_name, flags.do_eval, flags.max_train_samples) == ("d", False, 5)


def test_settings_are_checked():
    with pytest.raises(ValueError, match="do_step_schedule_per_epoch"):
        job_from_dict(Job, {"do_step_schedule_per_epoch": False})
    with pytest.raises(ValueError, match="twice"):
        job_from_dict(Job, {"dataset_name": "a", "dataset_name_or_path": "b"})
    with pytest.raises(ValueError, match="causal-lm, seq2seq"):
        LanguageModelJob(model_type="masked")


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a")], "k int, text string")
    assert require_columns(df, {"k": T.IntegerType, "text": None}) is df
    with pytest.raises(ValueError, match="'label' not found; choose one of k, text"):
        require_columns(df, ["label"])
    with pytest.raises(ValueError, match="has type int"):
        require_columns(df, {"k": T.StringType})


def test_feature_checks(spark):
    df = spark.createDataFrame([(1, [1]), (2, None), (3, [2])], "k int, input_ids array<int>")
    assert tuple(missing_features(df).first()) == (1, 3)
    with pytest.raises(ValueError, match="1/3"):
        require_features(df)
    assert require_features(df.where("k <> 2")).count() == 2
    with pytest.raises(PySparkException, match="row without input_ids"):
        assert_features(df).collect()
    kept, rejects = split_rejects(df, ["input_ids", "k"])
    assert kept.count() == 2 and [r["k"] for r in rejects.collect()] == [2]


def test_presence_is_tested_in_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None)], "k int, text string").write.parquet(f"{tmp_path}/t")
    kept = keep_complete(spark.read.parquet(f"{tmp_path}/t"), ["text"])
    assert "IsNotNull(text)" in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 1


def test_scan_of_split_folders(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test"))
    df.write.partitionBy("split").parquet(f"{tmp_path}/a/sub")
    df.where("split = 'train'").drop("split").write.json(f"{tmp_path}/b/train")
    df.write.parquet(f"{tmp_path}/c")
    pruned = scan_split(spark, f"{tmp_path}/a", "train", "sub")
    assert pruned.count() == 7
    assert "PartitionFilters: [isnotnull(split" in pruned._jdf.queryExecution().executedPlan().toString()
    assert scan_split(spark, f"{tmp_path}/b", "train", fmt="json", schema="id long").where("split = 'train'").count() == 7
    assert scan_split(spark, f"{tmp_path}/c", "test").count() == 3
    assert scan_split(spark, f"{tmp_path}/c").count() == 10
    assert scan_split(spark, f"{tmp_path}/b/train", "train", fmt="json").where("split = 'train'").count() == 7
    with pytest.raises(ValueError, match="no split"):
        scan_split(spark, f"{tmp_path}/b/train", "test", fmt="json")
    with pytest.raises(ValueError):
        union_splits({})


class Cluster:
    """A session on a cluster, as far as the choice of the shared folder needs it."""

    def __init__(self, named=None):
        self.sparkContext, self.conf = self, self
        self.master, self.named, self.used = "spark://host:7077", named, None

    def get(self, name, default):
        return self.named if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.used

    def setCheckpointDir(self, folder):
        self.used = folder


def test_shared_folder_follows_the_session(spark):
    cluster = Cluster("hdfs:///shared/")
    assert shared_dir(cluster) == "hdfs:///shared/" and cluster.used == "hdfs:///shared/"
    assert new_path(cluster, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
    assert shared_dir(spark) == shared_dir(spark)


def test_pinned_tables_can_be_dropped(spark):
    first = pin(spark.range(3))
    with temporary_tables(spark):
        inner = pin(spark.range(4))
        path = inner.inputFiles()[0]
        assert file_exists(spark, path)
    assert not file_exists(spark, path)
    assert first.count() == 3


def test_cache_is_used_until_input_or_settings_change(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"{tmp_path}/cache"
    spark.range(5).write.parquet(source)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(source).withColumn("split", F.lit("train"))

    run = lambda config, overwrite=False: store.prepared_cache(spark, root, config, [source], build, overwrite)
    assert [run({"a": 1})[1], run({"a": 1})[1], run({"a": 2})[1], run({"a": 1}, True)[1]] == [False, True, False, False]
    spark.range(3).write.mode("append").parquet(source)
    df, found = run({"a": 1})
    assert not found and df.count() == 8 and len(built) == 4


def test_metrics_append(spark, tmp_path):
    rows = spark.createDataFrame([("r", "eval", "loss", 0.5)], "run string, split string, metric string, value double")
    store.write_metrics(rows, f"{tmp_path}/m")
    store.write_metrics(rows.withColumn("run", F.lit("s")), f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m").count() == 2


def texts(spark, tmp_path, name="texts"):
    rows = [(i, f"w{i % 5} common {'x ' * (i % 4)}", ["a", "b", "c"][i % 3]) for i in range(60)]
    path = f"{tmp_path}/{name}"
    spark.createDataFrame([*rows, (60, None, "a"), (61, "t", None)], "id int, text string, label string").withColumn(
        "split", F.lit("train")
    ).write.partitionBy("split").parquet(path)
    return path


def test_validation_is_cut_only_when_wanted(spark, tmp_path):
    path = texts(spark, tmp_path)
    settings = {"dataset_name": path, "text_column_name": "text", "label_column_name": "label"}
    sizes = lambda job: {r["split"]: r["count"] for r in load_splits(spark, job).groupBy("split").count().collect()}
    assert sizes(job_from_dict(TextClassJob, settings)) == {"train": 52, "validation": 10}
    assert sizes(job_from_dict(TextClassJob, settings | {"do_eval": False})) == {"train": 62}
    assert sizes(job_from_dict(TextClassJob, settings | {"do_train": False})) == {"validation": 10}
    with pytest.raises(ValueError, match="'nothing' not found"):
        load_splits(spark, job_from_dict(TextClassJob, settings | {"text_column_name": "nothing"}))


def test_text_class_job(spark, tmp_path):
    job = job_from_dict(
        TextClassJob,
        {
            "dataset_name_or_path": texts(spark, tmp_path), "text_column_name": "text", "label_column_name": "label",
            "output_dir": f"{tmp_path}/out", "cache_dir": f"{tmp_path}/cache", "per_device_train_batch_size": 4,
            "max_eval_samples": 5, "weight_decay": 0.01,
        },
    )
    report = run_job(spark, job)
    batches = spark.read.parquet(f"{tmp_path}/out/batches")
    assert report.agg(F.sum("rows")).first()[0] == batches.count()
    assert batches.where("split = 'validation'").count() <= 5
    widths = batches.groupBy("split", "shard", "batch_id").agg(F.countDistinct(F.size("input_ids")).alias("n"))
    assert widths.where("n <> 1").count() == 0
    assert batches.where(F.size("input_ids") != F.size("attention_mask")).count() == 0
    rejects = {r["id"]: r["error"] for r in spark.read.parquet(f"{tmp_path}/out/rejects").collect()}
    assert set(rejects.values()) <= {"missing: text", "missing: label"}
    assert batches.count() + len(rejects) >= 52
    assert [r["label"] for r in spark.read.parquet(f"{tmp_path}/out/labels").orderBy("id").collect()] == ["a", "b", "c"]
    assert json.loads((tmp_path / "out" / "job.json").read_text())["trainer"] == {"weight_decay": 0.01}
    assert run_job(spark, job).count() >= 1


def test_validation_alone_with_given_vocabularies(spark, tmp_path):
    settings = {"dataset_name": texts(spark, tmp_path), "text_column_name": "text", "label_column_name": "label"}
    run_job(spark, job_from_dict(TextClassJob, settings | {"output_dir": f"{tmp_path}/first"}))
    given = {"label_vocab_path": f"{tmp_path}/first/labels", "token_vocab_path": f"{tmp_path}/first/tokens"}
    run_job(spark, job_from_dict(TextClassJob, settings | given | {"do_train": False, "output_dir": f"{tmp_path}/second"}))
    first = spark.read.parquet(f"{tmp_path}/first/batches").where("split = 'validation'")
    second = spark.read.parquet(f"{tmp_path}/second/batches")
    assert second.select("split").distinct().count() == 1
    assert sorted(map(str, first.select(second.columns).collect())) == sorted(map(str, second.collect()))


def test_job_from_the_command_line(spark, tmp_path, capsys):
    flags = ["--dataset_name", texts(spark, tmp_path), "--text_column_name", "text", "--label_column_name", "label"]
    main(["text-class", *flags, "--output_dir", f"{tmp_path}/cli", "--logging_steps", "5", "--max_length", "2"])
    assert "split=validation" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/cli/batches").where("size(input_ids) > 2").count() == 0
    with pytest.raises(SystemExit):
        main(["translate"])


def test_label_seen_only_in_validation(spark):
    rows = [(0, "train", "x", "a"), (1, "validation", "x", "new")]
    df = spark.createDataFrame(rows, "id int, split string, text string, label string")
    job = TextClassJob(text_column_name="text", label_column_name="label")
    with pytest.raises(PySparkException, match="label not in vocabulary: new"):
        text_class_batches(df, job).collect()
    kept = text_class_batches(df, TextClassJob(text_column_name="text", label_column_name="label", on_unknown_label="drop"))
    assert [r["id"] for r in kept.collect()] == [0]


@pytest.mark.parametrize("model_type", ["causal-lm", "seq2seq"])
def test_language_model_job(spark, tmp_path, model_type):
    rows = [(i, f"Question {i} " + "q " * i, f"Answer {i}") for i in range(12)]
    df = spark.createDataFrame(rows, "id int, source string, target string")
    union_splits({"train": df.where("id < 9"), "validation": df.where("id >= 9")}).write.partitionBy("split").parquet(f"{tmp_path}/d")
    job = LanguageModelJob(
        dataset_name=f"{tmp_path}/d", model_type=model_type, text_column_name="source", source_column_name="source",
        target_column_name="target", max_tokens_length=6.0, per_device_train_batch_size=2, per_device_eval_batch_size=3,
        output_dir=f"{tmp_path}/o", do_lower_case=True, shards=2,
    )
    run_job(spark, job)
    got = spark.read.parquet(f"{tmp_path}/o/batches")
    assert got.count() == 12 and got.agg(F.max("tokens_input_length")).first()[0] == 6
    if model_type == "causal-lm":
        assert got.where("labels <> input_ids").count() == 0
    else:
        assert got.where("size(labels) <> 2").count() == 0
    tokens = {r["token"] for r in spark.read.parquet(f"{tmp_path}/o/tokens").collect()}
    assert "question" in tokens and "Question" not in tokens


def test_source_and_target_may_be_one_column(spark):
    df = spark.createDataFrame([(0, "train", "a b"), (1, "train", "b")], "id int, split string, text string")
    job = LanguageModelJob(model_type="seq2seq", source_column_name="text", target_column_name="text")
    rows = {r["id"]: r for r in lm_batches(df, job).collect()}
    assert rows[0]["labels"] == rows[0]["input_ids"] and rows[1]["labels"] == [rows[1]["input_ids"][0], 0]


def test_token_class_job(spark, tmp_path):
    rows = [(i, ["alpha", "be", "gamma"][: i % 3 + 1], ["X", "O", "Y"][: i % 3 + 1]) for i in range(20)]
    spark.createDataFrame(rows, "id int, tokens array<string>, ner_tags array<string>").withColumn(
        "split", F.lit("train")
    ).write.partitionBy("split").parquet(f"{tmp_path}/d")
    job = TokenClassJob(
        dataset_name=f"{tmp_path}/d", text_column_name="tokens", label_column_name="ner_tags", encoder="chunk",
        encoder_width=3, output_dir=f"{tmp_path}/o", add_special_tokens=True,
    )
    run_job(spark, job)
    got = spark.read.parquet(f"{tmp_path}/o/batches")
    assert got.count() == 20 and got.where("size(labels) <> size(input_ids)").count() == 0
    kept = got.select("id", F.size(F.filter("labels", lambda v: v != -100)).alias("n"))
    assert kept.where(F.col("n") != F.col("id") % 3 + 1).count() == 0


def pictures(spark):
    good = [encode_png(np.full((4, 4, c), i, np.uint8)) for i, c in enumerate([1, 3, 1, 3, 4])]
    cells = [*good, b"junk", None, good[0]]
    labels = ["cat", "dog", "cat", "dog", "cat", "dog", "cat", None]
    return spark.createDataFrame([(i, c, labels[i], [labels[i], "it's"]) for i, c in enumerate(cells)], "id int, image binary, label string, tags array<string>")


@pytest.mark.parametrize("shards", [None, 2])
@pytest.mark.parametrize("as_url", [False, True])
def test_image_class_job(spark, tmp_path, shards, as_url):
    df = pictures(spark)
    if as_url:
        urls = [
            (r["id"], None if r["image"] is None else "data:;base64," + base64.b64encode(r["image"]).decode(), r["label"])
            for r in df.collect()
        ]
        df = spark.createDataFrame(urls, "id int, image string, label string")
    df.withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{tmp_path}/d")
    job = ImageClassJob(
        dataset_name=f"{tmp_path}/d", image_column_name="image", label_column_name="label", do_eval=False,
        output_dir=f"{tmp_path}/o", shards=shards, per_device_train_batch_size=2, image_height=2, image_width=2,
    )
    run_job(spark, job)
    got = spark.read.parquet(f"{tmp_path}/o/batches")
    assert {r["id"]: r["labels"] for r in got.collect()} == {0: 0, 1: 1, 2: 0, 3: 1}
    assert got.where("size(pixel_values) <> 12").count() == 0
    rejects = {r["id"]: r["error"] for r in spark.read.parquet(f"{tmp_path}/o/rejects").collect()}
    assert set(rejects) == {4, 5, 6, 7} and rejects[4] == "pixels: 4 channels" and rejects[7] == "no label"


def test_image_class_job_from_a_folder_of_files(spark, tmp_path):
    """Pictures that Spark's image source reads: classes are folders, a broken file is a reject."""
    for k, name in enumerate(("cat", "dog", "cat")):
        (tmp_path / "d" / name).mkdir(parents=True, exist_ok=True)
        pixels = np.zeros((4, 4, 3), np.uint8)
        pixels[..., 0] = 10 * k
        (tmp_path / "d" / name / f"{k}.png").write_bytes(encode_png(pixels))
    (tmp_path / "d" / "dog" / "bad.png").write_bytes(b"junk")
    job = ImageClassJob(
        dataset_name=f"{tmp_path}/d", dataset_format="image", dataset_options={"recursiveFileLookup": "true"},
        key_column_name="origin", image_column_name="image", label_column_name="folder", do_eval=False,
        output_dir=f"{tmp_path}/o", image_height=2, image_width=2,
    )
    run_job(spark, job)
    got = {r["origin"][-5:]: (r["labels"], r["pixel_values"]) for r in spark.read.parquet(f"{tmp_path}/o/batches").collect()}
    assert {k: v[0] for k, v in got.items()} == {"0.png": 0, "1.png": 1, "2.png": 0}
    # Red comes first, and only red differs.
    assert got["0.png"][1][0] < got["2.png"][1][0] and got["0.png"][1][4:] == got["2.png"][1][4:]
    rejects = spark.read.parquet(f"{tmp_path}/o/rejects").collect()
    assert [(r["origin"][-7:], r["error"]) for r in rejects] == [("bad.png", "decode: unreadable file")]


def test_declared_image_labels_are_ids_already(spark):
    df = pictures(spark).where("id < 4").select("id", "image", (F.col("id") % 2).alias("label"), F.lit("train").alias("split"))
    named = df.withMetadata("label", {"names": ["zebra", "ant"]})
    job = ImageClassJob(image_column_name="image", label_column_name="label", do_eval=False)
    assert {r["id"]: r["labels"] for r in image_class_batches(named, job).collect()} == {0: 0, 1: 1, 2: 0, 3: 1}


def test_caption_job(spark, tmp_path):
    pictures(spark).withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{tmp_path}/d")
    job = CaptionJob(
        dataset_name=f"{tmp_path}/d", image_column_name="image", text_column_name="tags", do_eval=False,
        output_dir=f"{tmp_path}/o", per_device_train_batch_size=8,
    )
    run_job(spark, job)
    got = spark.read.parquet(f"{tmp_path}/o/batches")
    assert {r["id"] for r in got.collect()} == {0, 1, 2, 3, 7}
    tokens = {r["token"] for r in spark.read.parquet(f"{tmp_path}/o/tokens").collect()}
    assert {"['cat',", '"it\'s"]', "[None,"} <= tokens
    masked = F.zip_with("input_ids", "labels", lambda i, v: F.when(i == 0, v == -100).otherwise(v == i))
    assert got.where(~F.forall(masked, lambda ok: ok)).count() == 0


def test_each_url_is_fetched_once(spark, tmp_path, monkeypatch):
    from prepkit.sources import images

    log = tmp_path / "log"
    log.mkdir()
    folder = str(log)

    def served(address, timeout=None):
        """Answers a ``data:`` address, and notes the request in a folder that all workers see."""
        import os
        import uuid
        from io import BytesIO

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return BytesIO(base64.b64decode(address.partition(",")[2]))

    monkeypatch.setattr(images, "open_url", served)
    urls = [
        (r["id"], None if r["image"] is None else "data:;base64," + base64.b64encode(r["image"]).decode(), r["label"])
        for r in pictures(spark).collect()
    ]
    df = spark.createDataFrame(urls, "id int, image string, label string").withColumn("split", F.lit("train"))
    df.write.partitionBy("split").parquet(f"{tmp_path}/d")
    settings = dict(
        dataset_name=f"{tmp_path}/d", image_column_name="image", label_column_name="label", do_eval=False,
        cache_dir=f"{tmp_path}/cache", image_height=2, image_width=2,
    )
    run_job(spark, ImageClassJob(output_dir=f"{tmp_path}/o", **settings))
    # Rows that share a URL share one request.
    assert len(list(log.iterdir())) == len({u for _, u, _ in urls if u}) == 6
    # A second job with the same settings takes everything from the cache, rejects included.
    run_job(spark, ImageClassJob(output_dir=f"{tmp_path}/p", **settings))
    # Rows that share a URL share one request.
    assert len(list(log.iterdir())) == len({u for _, u, _ in urls if u}) == 6
    for name in ("batches", "rejects", "labels"):
        first, second = (spark.read.parquet(f"{tmp_path}/{o}/{name}") for o in "op")
        assert sorted(map(str, first.collect())) == sorted(map(str, second.select(first.columns).collect()))


@pytest.mark.parametrize("shards", [None, 2])
def test_pixels_are_made_after_the_shuffle(spark, shards):
    df = pictures(spark).withColumn("split", F.lit("train"))
    job = ImageClassJob(image_column_name="image", label_column_name="label", image_height=2, image_width=2, shards=shards)
    plan = image_class_batches(df, job)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("pixel_values") :].split("Exchange", 1)
    assert len(below) == 2 and "pixel_values" not in below[1]


def test_job_cache_follows_what_shapes_the_table(spark, tmp_path):
    path = texts(spark, tmp_path)
    base = dict(dataset_name=path, text_column_name="text", label_column_name="label", cache_dir=f"{tmp_path}/cache")

    def made(**more):
        """New folders in the cache, and the batches."""
        before = {p.name for p in (tmp_path / "cache").iterdir()} if (tmp_path / "cache").exists() else set()
        job = TextClassJob(**base | {"output_dir": f"{tmp_path}/o"} | more)
        run_job(spark, job)
        return {p.name for p in (tmp_path / "cache").iterdir()} - before

    assert len(made()) == 4
    assert not made() and not made(output_dir=f"{tmp_path}/other", trainer={"learning_rate": 1})
    spark.read.parquet(f"{tmp_path}/o/labels").write.parquet(f"{tmp_path}/vocabulary")
    given = {"label_vocab_path": f"{tmp_path}/vocabulary"}
    assert len(made(**given)) == 4 and not made(**given)
    more = spark.createDataFrame([("new", 3)], "label string, id int")
    more.write.mode("append").parquet(f"{tmp_path}/vocabulary")
    assert len(made(**given)) == 4
    # Overwriting replaces the stored table under the same name.
    stamp = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "cache").iterdir()}
    assert not made(overwrite_cache=True)
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "cache").iterdir()} != stamp


def test_dropped_labels_are_rejects(spark, tmp_path):
    rows = [(i, "train" if i < 8 else "validation", "x", "a" if i < 9 else "new") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, split string, text string, label string")
    df.write.partitionBy("split").parquet(f"{tmp_path}/d")
    job = TextClassJob(
        dataset_name=f"{tmp_path}/d", eval_split_name="validation", text_column_name="text", label_column_name="label",
        on_unknown_label="drop", output_dir=f"{tmp_path}/o",
    )
    run_job(spark, job)
    assert [(r["id"], r["error"]) for r in spark.read.parquet(f"{tmp_path}/o/rejects").collect()] == [(9, "label not in vocabulary")]
    assert spark.read.parquet(f"{tmp_path}/o/batches").count() == 9


def test_head_is_fitted_and_evaluated_by_the_job(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, "t", "ab"[i % 2], (rng.normal(size=8) + 3 * (i % 2)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, label string, v array<double>").withColumn("split", F.lit("train"))
    df.write.partitionBy("split").parquet(f"{tmp_path}/d")
    main([
        "text-class", "--dataset_name", f"{tmp_path}/d", "--text_column_name", "text", "--label_column_name", "label",
        "--vector_column_name", "v", "--output_dir", f"{tmp_path}/o", "--dataset_options", '{"mergeSchema": "true"}',
    ])
    found = {r["metric"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/o/metrics").collect()}
    assert found["eval_samples"] == 30 and found["eval_loss"] < 0.3 and found["eval_samples_per_second"] > 0
