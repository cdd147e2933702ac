"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # Message timestamps without a zone are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed state (and its expiry) lives on executor disks, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A task's rows have the processing time of one micro-batch: a day, or two, that it writes side by side. Without
    # this a task sorts all that it writes by day first.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


def build_session(app: str = "rillwork", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime settings that results and the sinks depend on, in a session somebody else built."""
    for key in ("spark.sql.session.timeZone",
                "spark.sql.streaming.stateStore.providerClass",
                "spark.sql.maxConcurrentOutputFileWriters"):
        spark.conf.set(key, DEFAULTS[key])
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine (tests, a laptop) may do without that setting and falls back to a
    local folder; elsewhere executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="rillwork-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`shared_dir` gave."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
