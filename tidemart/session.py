"""Session settings the package is designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE sizes the shuffle partitions at run time, splits skewed join partitions (also when
# that costs an extra exchange) and turns a join into a broadcast once a side is measured
# to be small.  RocksDB keeps streaming state off the JVM heap.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session with ``ENGINE_CONF``; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str, folder: str | None = None) -> str:
    """A fresh folder under ``folder``, or under the shared directory named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting: its driver and executors are
    one process, so a local temporary folder is visible to all of them.
    """
    shared = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tidemart-")
    return f"{shared.rstrip('/')}/tidemart-{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Lets each query of a block that writes in many steps take its shuffle files along when it ends.

    Otherwise they lie on the executors' disks until the driver happens to collect garbage.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def folders_side_by_side(spark: SparkSession, most: int = 8) -> Iterator[None]:
    """Lets a task of a block write into a few folders at a time, instead of sorting its rows by folder first.

    A task that meets more folders sorts the rest; the writers' buffers bound ``most``.
    """
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield
