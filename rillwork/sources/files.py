"""Small text files in whatever file system Spark writes to: manifests, logs and markers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist. Hidden ones are left out."""
    target, fs = _open(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(n for s in fs.listStatus(target) if not (n := s.getPath().getName()).startswith((".", "_")))


def text(spark: SparkSession, path: str) -> str:
    target, fs = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, content: str) -> None:
    """Make a text file appear whole: it is written under a hidden name, then renamed."""
    target, fs = _open(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.new")
    stream = fs.create(hidden, True)
    try:
        stream.write(content.encode())
    finally:
        stream.close()
    if not fs.rename(hidden, target):
        raise OSError(f"cannot publish {path}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder that this library wrote."""
    target, fs = _open(spark, path)
    fs.delete(target, True)
