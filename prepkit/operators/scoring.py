"""Classification head: pooling, scores, probabilities, loss, evaluation and fitting."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.functions.bind import bind

# Keeps the logarithm finite; the label that counts for nothing.
EPSILON = 1e-10
IGNORE = -100
#: Groups of tasks whose gradients are added first.
GRADIENT_GROUPS = 64


@dataclass(frozen=True)
class HeadWeights:
    """Weights of the two linear layers, each of shape (outputs, inputs)."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray


def mean_pool(
    df: DataFrame, seq: str | Sequence[str], vec: str, mask: str | None = None, out: str = "pooled"
) -> DataFrame:
    """Mean vector of each sequence over all its tokens; with ``mask``, over those marked 1.

    A sequence without a marked token has a null mean.
    """
    seq = [seq] if isinstance(seq, str) else list(seq)
    values = F.col(vec).cast("array<double>")
    if mask is None:
        vectors = df.select(*seq, array_to_vector(values).alias("__v"))
        # Partial means leave each task, so a long sequence is not gathered in one place.
        return vectors.groupBy(*seq).agg(vector_to_array(Summarizer.mean(F.col("__v"))).alias(out))
    chosen = F.coalesce(F.col(mask) == 1, F.lit(False))
    zeros = F.transform(values, lambda x: F.lit(0.0))
    marked = F.when(chosen, values).otherwise(zeros)
    vectors = df.select(*seq, array_to_vector(marked).alias("__v"), chosen.cast("int").alias("__c"))
    sums = vectors.groupBy(*seq).agg(
        vector_to_array(Summarizer.sum(F.col("__v"))).alias("__s"), F.sum("__c").alias("__n")
    )
    mean = F.when(F.col("__n") > 0, F.transform("__s", lambda x: x / F.col("__n")))
    return sums.select(*seq, mean.alias(out))


def score_head(df: DataFrame, col: str, weights: HeadWeights, out: str = "logits") -> DataFrame:
    """Add linear -> ReLU -> linear scores of a vector column, one matrix product per Arrow batch."""
    parts = (weights.hidden, weights.hidden_bias, weights.output, weights.output_bias)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("array<double>")
    def score(vectors: pd.Series) -> pd.Series:
        hidden_weights, hidden_bias, output_weights, output_bias = shared.value
        given = [v for v in vectors if v is not None]
        if not given:
            return pd.Series([None] * len(vectors), dtype=object)
        x = np.stack(given).astype("float64")
        hidden = np.maximum(x @ hidden_weights.T + hidden_bias, 0.0)
        scores = iter(hidden @ output_weights.T + output_bias)
        return pd.Series([None if v is None else next(scores) for v in vectors], dtype=object)

    return df.withColumn(out, score(col))


def softmax(logits: Column) -> Column:
    """Probabilities of an array of scores; the largest score and the total are computed once."""
    raised = bind(
        F.struct(logits.alias("z"), F.array_max(logits).alias("top")),
        lambda s: F.transform(s["z"], lambda z: F.exp(z - s["top"])),
    )

    def share(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
        return bind(F.struct(e.alias("e"), total.alias("sum")), lambda s: F.transform(s["e"], lambda x: x / s["sum"]))

    return bind(raised, share)


def with_probabilities(df: DataFrame, col: str = "logits", out: str = "probabilities") -> DataFrame:
    return df.withColumn(out, softmax(F.col(col)))


def row_loss(probabilities: Column, label: Column) -> Column:
    """Negative log of the probability of the row's label; null without a label or for -100."""
    wrong = F.raise_error(F.concat(F.lit("no class "), label.cast("string"))).cast("double")
    return F.when(label != IGNORE, F.when(label < 0, wrong).otherwise(
        -F.log(F.element_at(probabilities, label + 1) + F.lit(EPSILON))
    ))


def nll_loss(
    df: DataFrame, probabilities: str = "probabilities", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Mean loss over the rows that have a label."""
    return df.groupBy(*by).agg(F.avg(row_loss(F.col(probabilities), F.col(label))).alias("loss"))


def evaluate(
    df: DataFrame,
    vec: str,
    label: str,
    weights: HeadWeights | None = None,
    split: str = "validation",
    run: str = "run",
) -> DataFrame:
    """Metrics table ``(run, split, metric, value)`` of one split.

    Without ``weights``, ``vec`` already holds scores.
    """
    rows = df.where(F.col("split") == split)
    logits = vec
    if weights is not None:
        rows, logits = score_head(rows, vec, weights, "__logits"), "__logits"
    scored = with_probabilities(rows, logits, "__p")
    summary = scored.agg(
        F.avg(row_loss(F.col("__p"), F.col(label))).alias("eval_loss"),
        F.count(F.lit(1)).cast("double").alias("eval_samples"),
    )
    return metrics_rows(summary, run, split)


def evaluate_timed(
    df: DataFrame,
    vec: str,
    label: str,
    weights: HeadWeights | None = None,
    split: str = "validation",
    run: str = "run",
) -> DataFrame:
    """``evaluate`` carried out now, with its run time and rows per second."""
    start = time.perf_counter()
    found = {r["metric"]: r["value"] for r in evaluate(df, vec, label, weights, split, run).collect()}
    seconds = time.perf_counter() - start
    found |= {"eval_runtime": seconds, "eval_samples_per_second": found["eval_samples"] / seconds}
    rows = [(run, split, name, value) for name, value in found.items()]
    return df.sparkSession.createDataFrame(rows, "run string, split string, metric string, value double")


def metrics_rows(summary: DataFrame, run: str, split: str) -> DataFrame:
    """A one-row table of numbers turned into ``(run, split, metric, value)`` rows."""
    listed = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in summary.columns
    ])
    return (
        summary.select(F.explode(listed).alias("m"))
        .select(F.lit(run).alias("run"), F.lit(split).alias("split"), "m.metric", "m.value")
    )


def start_weights(width: int, num_labels: int, seed: int, spread: float = 0.02) -> HeadWeights:
    """Weights to begin with: normally distributed around 0, biases 0."""
    rng = np.random.default_rng(seed)
    hidden = width // 2
    return HeadWeights(
        rng.normal(0.0, spread, (hidden, width)), np.zeros(hidden), rng.normal(0.0, spread, (num_labels, hidden)), np.zeros(num_labels)
    )


def _gradient(weights: HeadWeights, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss of some rows, and its summed derivative by all weights, one after the other."""
    before = x @ weights.hidden.T + weights.hidden_bias
    hidden = np.maximum(before, 0.0)
    z = hidden @ weights.output.T + weights.output_bias
    raised = np.exp(z - z.max(axis=1, keepdims=True))
    p = raised / raised.sum(axis=1, keepdims=True)
    own = p[np.arange(len(y)), y]
    by_scores = p.copy()
    by_scores[np.arange(len(y)), y] -= 1.0
    by_scores *= (own / (own + EPSILON))[:, None]
    by_hidden = (by_scores @ weights.output) * (before > 0)
    parts = (by_hidden.T @ x, by_hidden.sum(axis=0), by_scores.T @ hidden, by_scores.sum(axis=0))
    return float(-np.log(own + EPSILON).sum()), np.concatenate([g.ravel() for g in parts])


def head_gradient(df: DataFrame, vec: str, label: str, weights: HeadWeights) -> tuple[int, float, HeadWeights | None]:
    """Labelled rows, their mean loss and its derivative by the weights.

    Each task sums over its rows; the sums are added by groups of tasks first, and then over the groups, so
    that no task and not the driver receives one from every task. Rows without a vector or a label, and
    those labelled -100, count for nothing.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)
    classes = len(weights.output_bias)

    def sums(batches):
        n, loss, total = 0, 0.0, None
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), dtype="float64")
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(int)
            if not len(y):
                continue
            if y.min() < 0 or y.max() >= classes:
                raise ValueError(f"no class {y.min() if y.min() < 0 else y.max()}")
            more, part = _gradient(shared.value, x, y)
            n, loss, total = n + len(y), loss + more, part if total is None else total + part
        if n:
            columns = [pa.array([TaskContext.get().partitionId()]), pa.array([n]), pa.array([loss]), pa.array([total.tolist()])]
            yield pa.RecordBatch.from_arrays(columns, ["task", "n", "loss", "gradient"])

    used = df.where(F.col(vec).isNotNull() & (F.col(label) != IGNORE))
    parts = used.select(F.col(vec).cast("array<double>"), F.col(label).cast("long")).mapInArrow(
        sums, "task long, n long, loss double, gradient array<double>"
    )
    grouped = parts.select(
        F.pmod("task", F.lit(GRADIENT_GROUPS)).alias("task"), "n", "loss", array_to_vector("gradient").alias("g")
    )
    added = (F.sum("n").alias("n"), F.sum("loss").alias("loss"), Summarizer.sum(F.col("g")).alias("g"))
    row = grouped.groupBy("task").agg(*added).withColumn("all", F.lit(0)).groupBy("all").agg(*added).first()
    if row is None:
        return 0, float("nan"), None
    flat, shaped = row["g"].toArray() / row["n"], []
    for w in (weights.hidden, weights.hidden_bias, weights.output, weights.output_bias):
        shaped.append(flat[: w.size].reshape(w.shape))
        flat = flat[w.size :]
    return row["n"], row["loss"] / row["n"], HeadWeights(*shaped)


def fit_head(
    df: DataFrame, vec: str, label: str, weights: HeadWeights, steps: int, rate: float
) -> tuple[HeadWeights, list[float]]:
    """Full-batch gradient steps for the head that ``score_head`` scores; also the mean loss before each step.

    ``df`` is read once per step: store it first. Without a labelled row the weights stay.
    """
    losses = []
    for _ in range(steps):
        n, loss, gradient = head_gradient(df, vec, label, weights)
        if not n:
            break
        losses.append(loss)
        pairs = zip(vars(weights).values(), vars(gradient).values(), strict=True)
        weights = HeadWeights(*(w - rate * g for w, g in pairs))
    return weights, losses


def train_head(
    df: DataFrame, vec: str, label: str, num_labels: int, steps: int = 100, seed: int = 42
) -> MultilayerPerceptronClassificationModel:
    """Fit a head of the shape H -> H//2 -> labels on frozen vectors.

    Differs from the scored head in its sigmoid hidden units and its full-batch optimiser.
    """
    rows = df.select(
        array_to_vector(F.col(vec).cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
    )
    width = df.select(F.size(vec).alias("n")).first()["n"]
    trainer = MultilayerPerceptronClassifier(
        layers=[width, width // 2, num_labels], maxIter=steps, seed=seed, blockSize=128
    )
    return trainer.fit(rows)


def apply_trained_head(df: DataFrame, model: MultilayerPerceptronClassificationModel, vec: str) -> DataFrame:
    """Add the ``logits`` and the ``probabilities`` of a fitted head."""
    scored = model.transform(df.withColumn("features", array_to_vector(F.col(vec).cast("array<double>"))))
    return (
        scored.withColumn("logits", vector_to_array("rawPrediction"))
        .withColumn("probabilities", vector_to_array("probability"))
        .drop("features", "rawPrediction", "probability")
    )
