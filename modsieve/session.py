"""Session helpers: a local session for development, and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows that go to Python at once where each becomes a long vector.
SMALL_BATCH = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Single-machine session used by the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("modsieve")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="modsieve-")  # goes when Python ends
        context.setCheckpointDir(_local_dirs[app].name)
    return _local_dirs[app].name


def work_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(shared_dir(spark), spark.sparkContext.applicationId, *parts)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later readers do not recompute, lost executors do not matter."""
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints of tables that nothing refers to any more.

    It does so when the driver's garbage is collected, which a large heap may put off until the disks are full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned inside hands at most ``SMALL_BATCH`` rows at once to Python, so that its memory and the
    buffers beside the heap do not follow the usual 10,000 rows."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(SMALL_BATCH, int(before)) if int(before) > 0 else SMALL_BATCH))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)
