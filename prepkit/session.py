"""Session set-up, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SPLIT_BYTES = 128 * 1024 * 1024
SPREAD_BYTES = 4 * 1024 * 1024 * 1024
#: Bytes of rows that tasks hand to Python at a time; both sides hold such a batch, in buffers that grow by doubling.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 * 1024 * 1024

_pinned: list[str] = []
_sessions: list[SparkSession] = []


def get_session(app_name: str = "prepkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows carry whole texts or images, so Arrow batches stay short.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        BATCH_SETTING: str(BATCH_BYTES),
        # Vocabulary literals would otherwise fill the plan text.
        "spark.sql.maxPlanStringLength": "200000",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def short_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session that was not made by ``get_session``, for this and later queries.

    A bound that the session already has is left as it is. Results do not depend on it.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="prepkit-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Compute once into a table in the shared folder and continue from there.

    Later readers scan only the columns they need, and lost executors cost no recomputation. The table
    goes at the end of a job (see ``temporary_tables``), or when the driver ends.
    """
    path = new_path(df.sparkSession, name)
    _pinned.append(path)
    if not _sessions:
        atexit.register(_drop_pinned)
    _sessions[:] = [df.sparkSession]
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._pinned_path = path
    return stored


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Drop the tables pinned inside the block when it ends, but for those put into the list.

    Results must be stored by then.
    """
    before, kept = set(_pinned), []
    try:
        yield kept
    finally:
        names = {getattr(df, "_pinned_path", None) for df in kept}
        for path in [p for p in _pinned if p not in before and p not in names]:
            _pinned.remove(path)
            _delete(spark, path)


def unpin(*tables: DataFrame) -> None:
    """Drop tables returned by ``pin`` before their time; nothing that is still to be computed may read them."""
    for df in tables:
        path = getattr(df, "_pinned_path", None)
        if path in _pinned:
            _pinned.remove(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = hadoop_path(spark, path)
    file_system(spark, target).delete(target, True)


def _drop_pinned() -> None:
    """At the end of the driver; a session that has been stopped can reach its file system no more."""
    spark = _sessions[-1]
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        while _pinned:
            _delete(spark, _pinned.pop())


def pin_ordered(df: DataFrame) -> DataFrame:
    """As ``pin``, keeping partitions and their order."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Spread a small table over all cores before heavy per-row work.

    A small file may hold a single row group, which one task would read and process alone. Larger
    inputs, and those in as many files as cores, keep the partitions of their scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > min(cores * SPLIT_BYTES, SPREAD_BYTES) or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, *key)


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size, computed as one aggregate."""
    width = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
        else:
            width = width + 8
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its measured size allows; otherwise leave the join to shuffle.

    Pass a pinned or stored table: the measurement reads it once.
    """
    return F.broadcast(df) if is_small(df, limit) else df


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def file_exists(spark: SparkSession, path: str) -> bool:
    target = hadoop_path(spark, path)
    return file_system(spark, target).exists(target)
