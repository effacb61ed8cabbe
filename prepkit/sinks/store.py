"""Writing prepared tables, label vocabularies, assets and metrics, and reusing earlier results."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.session import file_exists, file_system, hadoop_path


def write_prepared(df: DataFrame, path: str, split: str = "split", files_per_split: int | None = None) -> DataFrame:
    """Store a prepared table with one folder per split; returns a report ``(split, file, rows)``."""
    if files_per_split:
        df = df.repartition(files_per_split)
    df.write.mode("overwrite").partitionBy(split).parquet(path)
    return prepared_files(df.sparkSession, path, split)


def prepared_files(spark: SparkSession, path: str, split: str = "split") -> DataFrame:
    """Rows per stored file of each split."""
    stored = spark.read.parquet(path).select(split, F.col("_metadata.file_path").alias("file"))
    return stored.groupBy(split, "file").agg(F.count(F.lit(1)).alias("rows"))


def inputs_digest(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the names, sizes and change times of the files under ``paths``, content unread."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        .select(F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)").alias("h"))
    )
    row = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{row['n']}:{row['h']}"


def fingerprint(spark: SparkSession, config: Mapping, paths: Sequence[str]) -> str:
    text = json.dumps(dict(config), sort_keys=True, default=str) + inputs_digest(spark, paths)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def prepared_cache(
    spark: SparkSession,
    root: str,
    config: Mapping,
    inputs: Sequence[str],
    build: Callable[[], DataFrame],
    overwrite: bool = False,
) -> tuple[DataFrame, bool]:
    """The table for this configuration and these input files, and whether it was there already.

    ``build`` runs only when no finished table is stored, or when ``overwrite`` asks for it.
    """
    path = f"{root.rstrip('/')}/{fingerprint(spark, config, inputs)}"
    found = not overwrite and file_exists(spark, f"{path}/_SUCCESS")
    if not found:
        made = build()
        folders = [c for c in ("split",) if c in made.columns]
        made.write.mode("overwrite").partitionBy(*folders).parquet(path)
    return spark.read.parquet(path), found


def write_label_vocab(vocab: DataFrame, path: str) -> DataFrame:
    """Store the label table next to the data; returns the stored table."""
    vocab.coalesce(1).write.mode("overwrite").parquet(path)
    return vocab.sparkSession.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append ``(run, split, metric, value)`` rows."""
    metrics.select("run", "split", "metric", "value").coalesce(1).write.mode("append").parquet(path)


def write_assets(spark: SparkSession, folder: str, assets: Mapping[str, str | Mapping]) -> list[str]:
    """Store small text assets once, from the driver; mappings are stored as JSON."""
    written = []
    for name, content in assets.items():
        text = content if isinstance(content, str) else json.dumps(dict(content), indent=2, sort_keys=True)
        target = hadoop_path(spark, f"{folder.rstrip('/')}/{name}")
        stream = file_system(spark, target).create(target, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        written.append(target.toString())
    return written
