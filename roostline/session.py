"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# SQL settings only: cluster sizing (executors, shuffle partitions) stays with the caller.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Amenities that differ by case are different columns.
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot listing even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that are dealt by listing and month already also meet by listing, month and date.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "roostline", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # Recording the call site of every Column expression dominates plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="roostline-")
    folder = f"{shared.rstrip('/')}/roostline-{label}-{uuid.uuid4().hex}"
    for scope in _scopes()[-1:]:
        scope.add(folder)
    return folder


_OPEN = threading.local()


def _scopes() -> list[set[str]]:
    if not hasattr(_OPEN, "scopes"):
        _OPEN.scopes = []
    return _OPEN.scopes


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Scratch folders made inside the block go at its end. The block gets a function that keeps
    a table of :func:`staged`, for results that still read it; an enclosing block decides on it."""
    made: set[str] = set()
    kept: set[str] = set()

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table._scratch)
        return table

    _scopes().append(made)
    try:
        yield keep
    finally:
        _scopes().pop()
        for folder in made - kept:
            remove_scratch(spark, folder)
        for scope in _scopes()[-1:]:
            scope |= made & kept


def staged(df: DataFrame, label: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """``df`` as a table in a fresh scratch folder, and that folder. Later steps read files
    instead of repeating the work; the shuffle files of the write are removed at its end."""
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    with shuffles_removed(spark):
        df.write.option("compression", codec).parquet(folder)
    table = spark.read.schema(df.schema).parquet(folder)
    table._scratch = folder
    return table, folder


def staged_dealt(df: DataFrame, label: str, *keys: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """Like :func:`staged`, with the rows dealt by ``keys`` to as many buckets as there are shuffle
    partitions: joins and groups on these keys, or on more than these, read each bucket in a task
    and move none of its rows. A bucket is one file, since a task has the rows of one bucket."""
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Buckets are known to the catalog only. What was read from there does without it later.
    name = f"roostline_{uuid.uuid4().hex}"
    # A writer that is open beside others takes rows as they come; else a task would sort them.
    with shuffles_removed(spark), setting(spark, WRITERS, "2"):
        (
            df.repartition(buckets, *keys)
            .write.format("parquet")
            .option("compression", codec)
            .option("path", folder)
            .bucketBy(buckets, *keys)
            .saveAsTable(name)
        )
    try:
        table = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    table._scratch = folder
    return table, folder


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the steps in the block are removed at the end of each step."""
    return setting(spark, CLEANUP, "true")


def remove_scratch(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by :func:`scratch_dir`, on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
