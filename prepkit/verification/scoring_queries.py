"""Pooling, scores, probabilities, losses, evaluation and fitting, over the embeddings table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import scoring as ops
from prepkit.operators.scoring import HeadWeights
from prepkit.operators.splits import split_hash
from prepkit.session import new_path
from prepkit.sinks.store import write_metrics
from prepkit.verification.registry import micro_text, query, sql_hash_split, sql_micro, table

WIDTH, HIDDEN, CLASSES = 64, 32, 10


def fixed_weights() -> HeadWeights:
    """Weights given by a rule, so that SQL can state them too."""
    rule = lambda rows, cols: np.sin(np.arange(cols) + cols * np.arange(rows)[:, None])
    return HeadWeights(
        rule(HIDDEN, WIDTH), 0.01 * np.arange(HIDDEN), rule(CLASSES, HIDDEN), 0.02 * np.arange(CLASSES)
    )


SQL_HEAD = f"""h as (select vec_id, label, list_transform(range(0, {HIDDEN}), lambda j: greatest(0.0, 0.01 * j +
    list_sum(list_transform(embedding, lambda x, i: cast(x as double) * sin(i - 1 + {WIDTH} * j))))) as h from embeddings),
    z as (select vec_id, label, list_transform(range(0, {CLASSES}), lambda k: 0.02 * k +
    list_sum(list_transform(h, lambda x, i: x * sin(i - 1 + {HIDDEN} * k)))) as z from h)"""
SQL_SUMS = f"""z as (select vec_id, label, list_transform(range(0, {CLASSES}), lambda k: list_sum(list_transform(
    list_filter(embedding, lambda x, i: (i - 1) % {CLASSES} = k), lambda x: cast(x as double)))) as z from embeddings)"""
SQL_SOFTMAX = """e as (select vec_id, label, list_transform(z, lambda x: exp(x - list_max(z))) as e from z),
    p as (select vec_id, label, list_transform(e, lambda x: x / list_sum(e)) as p from e)"""


def summed_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per class from whole vectors: the sum of every tenth element, from that of the class on."""
    vector = F.col("embedding").cast("array<double>")

    def score(k: int):
        own = F.filter(vector, lambda x, i: i % CLASSES == k)
        return F.aggregate(own, F.lit(0.0), lambda total, x: total + x)

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.array(*map(score, range(CLASSES))).alias("logits")
    )


@query(
    f"""select label, {sql_micro('list(m order by i)')} as pooled from (select label, i, avg(x) as m from
    (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings)
    group by label, i) group by label"""
)
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = ops.mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return pooled.select("label", micro_text("pooled").alias("pooled"))


@query(
    f"""with p as (select label, {sql_micro('list(m order by i)')} as pooled from (select label, i, avg(x) as m from
    (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings
    where embedding[1] > 0 and label <> 3) group by label, i) group by label)
    select label, pooled from (select distinct label from embeddings) left join p using (label)"""
)
def mean_pool_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of one sequence are masked: it stays, without a mean."""
    marked = (F.col("embedding")[0] > 0) & (F.col("label") != 3)
    vectors = table(spark, sf_dir, "embeddings").withColumn("mask", marked.cast("int"))
    pooled = ops.mean_pool(vectors, "label", "embedding", mask="mask")
    return pooled.select("label", micro_text("pooled").alias("pooled"))


@query(f"with {SQL_HEAD} select vec_id, {sql_micro('z')} as logits from z")
def score_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ops.score_head(table(spark, sf_dir, "embeddings"), "embedding", fixed_weights())
    return scored.select("vec_id", micro_text("logits").alias("logits"))


@query(f"with {SQL_SUMS}, {SQL_SOFTMAX} select vec_id, {sql_micro('p')} as probabilities from p")
def softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ops.with_probabilities(summed_logits(spark, sf_dir))
    return done.select("vec_id", micro_text("probabilities").alias("probabilities"))


@query(f"with {SQL_SUMS}, {SQL_SOFTMAX} select round(avg(-ln(p[label + 1] + 1e-10)), 6) as loss from p")
def nll_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = ops.nll_loss(ops.with_probabilities(summed_logits(spark, sf_dir)))
    return loss.select(F.round("loss", 6).alias("loss"))


@query(
    f"""with {SQL_HEAD}, {SQL_SOFTMAX}, s as ({sql_hash_split('p', 'vec_id')}),
    m as (select round(avg(-ln(p[label + 1] + 1e-10)), 6) as eval_loss, cast(count(*) as double) as eval_samples
    from s where split = 'validation')
    select 'head' as run, 'validation' as split, metric, value from m
    unpivot (value for metric in (eval_loss, eval_samples))"""
)
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = split_hash(table(spark, sf_dir, "embeddings"), "vec_id")
    metrics = ops.evaluate(vectors, "embedding", "label", fixed_weights(), run="head")
    path = new_path(spark, "metrics")
    write_metrics(metrics, path)
    return spark.read.parquet(path).withColumn("value", F.round("value", 6))


STEPS, RATE = 3, 0.5


def start_weights() -> HeadWeights:
    """Small weights given by a rule, so that SQL can state them too."""
    w = fixed_weights()
    return HeadWeights(0.1 * w.hidden, w.hidden_bias, 0.1 * w.output, w.output_bias)


def sql_step(n: int) -> str:
    """Weights ``w{n}`` (layer, row, col; the bias has col -1) after a gradient step from those of ``n - 1``."""
    w, k = f"w{n - 1}", f"_{n}"
    return f"""
    a{k} as (select vec_id, w.row as j, b.v + sum(x.v * w.v) as a from x
      join (select * from {w} where layer = 1 and col >= 0) w on w.col = x.i
      join (select * from {w} where layer = 1 and col = -1) b on b.row = w.row group by vec_id, w.row, b.v),
    z{k} as (select vec_id, w.row as k, b.v + sum(greatest(a, 0.0) * w.v) as z from a{k}
      join (select * from {w} where layer = 2 and col >= 0) w on w.col = j
      join (select * from {w} where layer = 2 and col = -1) b on b.row = w.row group by vec_id, w.row, b.v),
    p{k} as (select vec_id, k, exp(z - max(z) over o) / sum(exp(z - top)) over o as p from
      (select *, max(z) over (partition by vec_id) as top from z{k}) window o as (partition by vec_id)),
    d{k} as (select vec_id, k, (p - (k = label)::int) * own / (own + 1e-10) / n as d from p{k}
      join (select vec_id, label, p as own from p{k} join y using (vec_id) where k = label) using (vec_id), n),
    h{k} as (select d{k}.vec_id, j, sum(d * w.v) as d from d{k}
      join (select * from {w} where layer = 2 and col >= 0) w on w.row = k join a{k} on a{k}.vec_id = d{k}.vec_id and j = w.col
      where a > 0 group by d{k}.vec_id, j),
    g{k} as (select 1 as layer, j as row, i as col, sum(d * v) as g from h{k} join x using (vec_id) group by all
      union all select 1, j, -1, sum(d) from h{k} group by j
      union all select 2, k, j, sum(d * greatest(a, 0.0)) from d{k} join a{k} using (vec_id) group by k, j
      union all select 2, k, -1, sum(d) from d{k} group by k),
    w{n} as materialized (select layer, row, col, v - {RATE} * coalesce(g, 0) as v from {w} left join g{k} using (layer, row, col))"""


SQL_TRAINED = f"""with s as ({sql_hash_split('embeddings', 'vec_id')}),
    y as (select vec_id, label from s where split = 'train'), n as (select count(*) as n from y),
    x as (select vec_id, unnest(embedding)::double as v, generate_subscripts(embedding, 1) - 1 as i from s where split = 'train'),
    w0 as (select 1 as layer, j as row, i as col, 0.1 * sin(i + {WIDTH} * j) as v from range({HIDDEN}) a(j), range({WIDTH}) b(i)
      union all select 1, j, -1, 0.01 * j from range({HIDDEN}) a(j)
      union all select 2, k, j, 0.1 * sin(j + {HIDDEN} * k) from range({CLASSES}) a(k), range({HIDDEN}) b(j)
      union all select 2, k, -1, 0.02 * k from range({CLASSES}) a(k)), {", ".join(map(sql_step, range(1, STEPS + 1)))}
    select layer, row, col, cast(round(v * 1e6) as bigint) as micro from w{STEPS}"""


@query(SQL_TRAINED)
def train_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weights of the head after three full-batch gradient steps on the train rows, in millionths."""
    train = split_hash(table(spark, sf_dir, "embeddings"), "vec_id").where("split = 'train'")
    weights, _ = ops.fit_head(train, "embedding", "label", start_weights(), STEPS, RATE)
    rows = []
    for layer, (w, bias) in enumerate(((weights.hidden, weights.hidden_bias), (weights.output, weights.output_bias)), 1):
        rows += [(layer, j, -1, float(b)) for j, b in enumerate(bias)]
        rows += [(layer, j, i, float(v)) for j, line in enumerate(w) for i, v in enumerate(line)]
    found = spark.createDataFrame(rows, "layer int, row long, col long, v double")
    return found.select("layer", "row", "col", F.round(F.col("v") * 1e6).cast("bigint").alias("micro"))


@query(
    f"""with s as ({sql_hash_split('embeddings', 'vec_id')}) select vec_id, label, true as in_range,
    true as improved from s where split = 'validation'"""
)
def train_perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's perceptron, which has the same layers: its classes are in range, its loss is below an even guess's."""
    vectors = split_hash(table(spark, sf_dir, "embeddings"), "vec_id")
    train = vectors.where("split = 'train'")
    model = ops.train_head(train, "embedding", "label", CLASSES, steps=30)
    # An even guess over the classes loses the logarithm of their number.
    loss = ops.nll_loss(ops.apply_trained_head(train, model, "embedding")).first()["loss"]
    scored = ops.apply_trained_head(vectors.where("split = 'validation'"), model, "embedding")
    predicted = F.col("prediction").cast("int")
    return scored.select(
        "vec_id", "label", predicted.between(0, CLASSES - 1).alias("in_range"),
        F.lit(loss < np.log(CLASSES)).alias("improved"),
    )
