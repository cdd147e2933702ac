"""Appending to tables, from batch and from streams.

A target with a slash is a path, anything else a catalog table. Missing tables are created.
Each stream has its own checkpoint, so one sink's failure leaves the others alone; the file sink
then writes each row once, also over a restart.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillwork.functions import day_of
from rillwork.schemas import conform
from rillwork.sources import files

AVAILABLE_NOW = {"availableNow": True}


def is_path(target: str) -> bool:
    return "/" in target


def _by_day(df: DataFrame, day_of_col: str | None) -> tuple[DataFrame, list[str]]:
    if day_of_col is None:
        return df, []
    day = f"{day_of_col}_day"
    return df.withColumn(day, day_of(F.col(day_of_col))), [day]


def append(df: DataFrame, target: str, schema: T.StructType | None = None,
           checkpoint: str | None = None, partition_by: str | None = None,
           trigger: dict | None = None, name: str | None = None, fmt: str = "parquet",
           **options: str) -> StreamingQuery | None:
    """Append rows in the declared schema; ``partition_by`` is a time column, cut to its day.

    Returns the running query for a stream, nothing for a batch. A partitioned batch is first
    rebalanced by day: each day gets files of even size, and a day that holds most rows is written
    by many tasks.
    """
    rows, parts = _by_day(conform(df, schema) if schema is not None else df, partition_by)
    if not rows.isStreaming:
        if parts:
            rows = rows.hint("rebalance", F.col(parts[0]))
        writer = rows.write.mode("append").format(fmt).options(**options).partitionBy(*parts)
        writer.save(target) if is_path(target) else writer.saveAsTable(target)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = (rows.writeStream.outputMode("append").format(fmt).options(**options)
              .option("checkpointLocation", checkpoint))
    if parts:
        writer = writer.partitionBy(*parts)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(target) if is_path(target) else writer.toTable(target)


def send(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None,
         trigger: dict | None = None) -> StreamingQuery | None:
    """Send key/value messages to a topic."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not messages.isStreaming:
        messages.write.format("kafka").options(**opts).save()
        return None
    writer = messages.writeStream.format("kafka").options(**opts).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


class Branch(NamedTuple):
    """One output of a fan-out: how to get its rows from a micro-batch, and where they go."""

    rows: Callable[[DataFrame], DataFrame]
    target: str
    schema: T.StructType | None = None
    partition_by: str | None = None


def stored_schema(df: DataFrame, schema: T.StructType | None, partition_by: str | None) -> T.StructType:
    """The columns that :func:`append` writes, the day column last."""
    rows, parts = _by_day(conform(df, schema) if schema is not None else df, partition_by)
    return rows.select(*[c for c in rows.columns if c not in parts], *parts).schema


def last_written(spark: SparkSession, marker: str) -> int:
    """The id of the last micro-batch that a marker tells of, -1 before the first."""
    return max((int(n) for n in files.names(spark, marker)), default=-1)


def mark_written(spark: SparkSession, marker: str, batch_id: int) -> None:
    """Note a batch; the notes before go, so the folder stays at one file."""
    files.publish(spark, f"{marker}/{batch_id}", "")
    for n in files.names(spark, marker):
        if int(n) < batch_id:
            files.remove(spark, f"{marker}/{n}")


def write_batch(df: DataFrame, batch_id: int, target: str, marker: str,
                schema: T.StructType | None = None, partition_by: str | None = None) -> None:
    """Append one micro-batch to a path or table, in the layout that :func:`append` gives.

    The marker, a folder of its own per target, keeps the id of the last written batch; a batch up to it
    is not written again. Only a driver that is lost between the two commits repeats one
    (``commits.write_together`` never does).
    """
    spark = df.sparkSession
    if batch_id <= last_written(spark, marker):
        return
    append(df, target, schema, partition_by=partition_by)
    mark_written(spark, marker, batch_id)


def start(stream: DataFrame, run, checkpoint: str, trigger: dict | None, name: str | None
           ) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_each(stream: DataFrame, transform: Callable[[DataFrame, int], DataFrame], target: str,
               checkpoint: str, schema: T.StructType | None = None,
               partition_by: str | None = None, trigger: dict | None = None,
               name: str | None = None) -> StreamingQuery:
    """Transform each micro-batch as a batch DataFrame, then append it. The micro-batch is kept while
    that goes on, so a transform that reads it several times does not run the stream's plan again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(transform(batch, batch_id), batch_id, target, f"{checkpoint}/written",
                        schema, partition_by)
        finally:
            batch.unpersist()

    return start(stream, run, checkpoint, trigger, name)


def write_all(stream: DataFrame, branches: list[Branch], checkpoint: str,
              trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Fan out one scan: each micro-batch is read once, kept, and appended to every branch.

    For stateless branches; a windowed count needs a query of its own.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for i, b in enumerate(branches):
                write_batch(b.rows(batch), batch_id, b.target, f"{checkpoint}/written-{i}", b.schema,
                            b.partition_by)
        finally:
            batch.unpersist()

    return start(stream, run, checkpoint, trigger, name)
