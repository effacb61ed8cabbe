"""The pipeline beside plain Python, stage by stage."""

import random
import re

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
import test_jaccard
import test_pii
import test_quality
import test_text_search
from helpers import SCHEMA, empty, table, with_clashes, words
from prepkit.llm import decontaminate, jaccard_join, packing, pii
from prepkit.session import BATCH_BYTES, BATCH_SETTING
from pyspark.sql import functions as F
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    items = [(k, " ".join(words(rng, 15))) for k in range(5)]
    texts = ["", None, "too short"]
    for k in range(60):
        w = words(rng, rng.randint(25, 90), 10**6)
        if k % 4 == 0:
            w[10:10] = items[k % 5][1].split()
        if k % 5 == 0:
            w[5:5] = ["mail", f"joe{k}@mail.example.com", "phone", "+1 (714) 555-9345"]
        if k % 7 == 0:
            w = [x + " ### |" for x in w]
        texts.append(" ".join(w))
    texts += [test_jaccard.near(rng, t, 0.02) for t in texts[3:20]] + texts[3:9]
    rows = [(i, t, "en", f"h{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = [(r[0], r[1], r[2], r[3], r[4]) for r in rows]
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (quality, classes, leaks, personal), strict=True):
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        left = brute(left, items)
        docs = spark.createDataFrame(out.collect(), SCHEMA)
        assert sorted(map(tuple, docs.collect())) == sorted(left), name
    assert 0 < len(left) < len(rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r[0]: [*library.encode(r[1], add_special_tokens=False).ids, 1] for r in left}
    for out in (corpus_pipeline.STAGES[-1][1](spark, docs, path), corpus_pipeline.run(spark, path)):
        got = {}
        for r in sorted(out.collect(), key=lambda r: (r["doc_id"], r["start"])):
            got.setdefault(r["doc_id"], []).extend(r["ids"])
        assert got == want


def quality(rows, items):
    """No host is trusted or bad here, so any failed rule counts."""
    out = []
    for r in rows:
        n, chars, symbols, lines, dup, again = test_quality.brute(r[1])
        if n >= 20 and 100 * again <= 30 * n and 100 * symbols <= 20 * n and 100 * dup <= 30 * lines and 2 * n <= chars <= 16 * n:
            out.append(r)
    return out


def classes(rows, items):
    keep = {c for _, _, c in test_jaccard.brute([(r[0], r[1]) for r in rows])}
    return [r for r in rows if r[0] in keep]


def leaks(rows, items):
    out = []
    windows = [test_text_search.letters(t)[p : p + 10] for _, t in items for p in range(len(test_text_search.letters(t)) - 9)]
    for r in rows:
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r[1].lower())]
        w = [r[1].lower()[a:b] for a, b in places]
        gone = {q for part in windows for p in range(len(w) - 9) if w[p : p + 10] == part for q in range(p, p + 10)}
        text, at = r[1], 0
        parts = []
        for p, (a, b) in enumerate(places):
            if p in gone:
                parts.append(r[1][at:a])
                at = b
        if gone:
            # Between two removed words there is only what separates them.
            first, last = min(gone), max(gone)
            text = " ".join(x for x in (r[1][: places[first][0]].rstrip(" "), r[1][places[last][1] :].lstrip(" ")) if x)
            assert len(gone) == last - first + 1
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def personal(rows, items):
    out = []
    for r in rows:
        text, parts, at = r[1], [], 0
        for kind, a, b in test_pii.brute(text):
            parts += [text[at:a], f"[{kind.upper()}]"]
            at = b
        text = "".join(parts) + text[at:]
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def test_empty_table(spark, folder):
    path, _, _ = folder
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), path).count() == 0, name


def test_clashing_columns_ties_and_null_ids(spark, folder):
    """Columns of any name go through; of equal texts one row stays, with the smallest id, a null first."""
    path, _, items = folder
    rng = random.Random(4)
    one, two = (" ".join(words(rng, 40, 10**6)) for _ in range(2))
    docs = with_clashes(table(spark, [one, one, two, two, two], [None, 5, 9, 7, 7], source=None))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr) == [(7, two), (None, one)]


def test_a_very_long_text_goes_through(spark, folder):
    path, _, items = folder
    rng = random.Random(5)
    long = " ".join(words(rng, 700_000, 10**7))
    leaked = f"{long[: 2_000_000]} {items[0][1]} {long[2_000_000:]}"
    docs = table(spark, [leaked, " ".join(words(rng, 30, 10**6))])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(left) == {0, 1} and items[0][1] not in left[0] and len(left[0]) > 4_000_000


@pytest.fixture
def plain(spark):
    """A session with Spark's own settings for Arrow."""
    session = spark.newSession()
    for name in (BATCH_SETTING, "spark.sql.execution.arrow.maxRecordsPerBatch"):
        session.conf.unset(name)
    yield session
    spark.createDataFrame([(1,)], "a int")  # the active session is the last one that made a table


OPERATORS = {
    "jaccard_join": lambda docs, items: jaccard_join.keep_one(docs),
    "decontamination": decontaminate.remove_leaks,
    "personal_data": lambda docs, items: pii.mask_personal(docs),
    "spans": lambda docs, items: pii.find_personal(docs),
    "packing": lambda docs, items: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_long_rows_reach_python_a_few_megabytes_at_a_time(plain, name):
    """An executor holds a batch on both sides, so Spark's 64 MB would be held several times by each task."""
    items = plain.createDataFrame([], "item_id long, text string")
    OPERATORS[name](empty(plain), items)
    text = F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), F.when(F.col("id") == 7, 10**6).otherwise(1000))
    docs = plain.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))

    def sizes(batches):
        for batch in batches:
            bytes_, rows = batch.nbytes, batch.num_rows
            yield pa.RecordBatch.from_pydict({"bytes": [bytes_], "rows": [rows]})

    found = docs.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in found) == 3000
    # The row that reaches the bound is the last of its batch.
    assert sorted(r["bytes"] > BATCH_BYTES + 10_000 for r in found).count(True) <= 1
    assert max(r["bytes"] for r in found) < 2 * BATCH_BYTES


def test_a_bound_of_the_session_stays(plain):
    plain.conf.set(BATCH_SETTING, "1000000")
    packing.pack(empty(plain), public_tokenizers.path("word_bpe_49k.json"))
    assert plain.conf.get(BATCH_SETTING) == "1000000"
