"""A dimension that is renewed on a clock, kept as differences.

At each tick the new snapshot is compared with the current rows by a digest per row; only inserted, changed and
deleted rows are written, as a version with the tick's time. A reader asks for the version as of a time, so
events see the profile that was current at theirs, also when a stream lags behind or is run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillwork.operators.asof import asof_join
from rillwork.sources import files
from rillwork.streaming.sinks import start

SINCE, GONE, DIGEST = "_since", "_gone", "_digest"


def clock(spark: SparkSession, every_seconds: int = 1800, first: datetime | None = None) -> DataFrame:
    """A stream with one row (``timestamp``) per micro-batch. With ``first`` ticks follow each other at once,
    ``every_seconds`` apart from then on (replays); else it is the wall clock, at the trigger's pace."""
    if first is None:
        return spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    millis = int(first.replace(tzinfo=first.tzinfo or timezone.utc).timestamp() * 1_000_000) // 1000
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
            .option("startTimestamp", millis).option("advanceMillisPerBatch", every_seconds * 1000).load())


class VersionedTable:
    """``schema`` are the dimension's columns, one row per ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "user_id"):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.stored = T.StructType([*schema.fields, T.StructField(DIGEST, T.LongType()),
                                    T.StructField(GONE, T.BooleanType()), T.StructField(SINCE, T.TimestampType())])

    def versions(self) -> list[dict]:
        """Published versions, oldest first: their number, their time, and whether anything changed."""
        folder = f"{self.path}/log"
        return [json.loads(files.text(self.spark, f"{folder}/{n}")) for n in files.names(self.spark, folder)]

    def history(self) -> DataFrame:
        """All differences: the columns, since when, and whether the row is gone since then."""
        folders = [f"{self.path}/data/{v['n']}" for v in self.versions() if v["changed"]]
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*folders)

    def as_of(self, time: datetime | None = None) -> DataFrame:
        """The rows of the newest version up to ``time``."""
        rows = self.history()
        if time is not None:
            rows = rows.where(F.col(SINCE) <= F.lit(time))
        rest = [c for c in (*self.schema.names, DIGEST, GONE) if c != self.key]
        best = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), SINCE).alias("_r"))
        return best.where(~F.col(f"_r.{GONE}")).select(
            *[F.col(c) if c == self.key else F.col(f"_r.{c}").alias(c) for c in (*self.schema.names, DIGEST)])

    def refresh(self, snapshot: DataFrame, time: datetime) -> int:
        """Write what differs from the current rows as a version of ``time``; the number of such rows. A time
        that a version has already is not written again; what a lost driver left half written is replaced."""
        done = self.versions()
        micros = int(time.replace(tzinfo=time.tzinfo or timezone.utc).timestamp() * 1_000_000)
        if done and done[-1]["micros"] >= micros:
            return 0
        names = self.schema.names
        new = snapshot.select(*names, F.xxhash64(*names).alias(DIGEST))
        old = self.as_of().select(F.col(self.key).alias("_key"), F.col(DIGEST).alias("_was"))
        both = new.join(old, F.col(self.key) == F.col("_key"), "full_outer")
        differs = both.where(F.col("_was").isNull() | F.col(DIGEST).isNull() | (F.col("_was") != F.col(DIGEST)))
        rows = differs.select(
            *[F.coalesce(self.key, "_key").alias(c) if c == self.key else F.col(c) for c in names], DIGEST,
            F.col(DIGEST).isNull().alias(GONE), F.timestamp_micros(F.lit(micros)).alias(SINCE))
        n = len(done)
        rows.write.mode("overwrite").parquet(f"{self.path}/data/{n}")
        count = self.spark.read.schema(self.stored).parquet(f"{self.path}/data/{n}").count()
        files.publish(self.spark, f"{self.path}/log/{n:012d}", json.dumps(
            {"n": n, "micros": micros, "changed": bool(count)}))
        return count

    def join(self, events: DataFrame, columns: list[str], time_col: str = "event_time",
             slice_width: str = "1 day") -> DataFrame:
        """Events with ``columns`` of the version that was current at their time."""
        seen = asof_join(events, self.history(), self.key, F.col(time_col), SINCE, [GONE, *columns], slice_width)
        there = F.coalesce(~F.col(GONE), F.lit(False))
        return seen.select(*events.columns, *[F.when(there, F.col(c)).alias(c) for c in columns])


def refresh_on(ticks: DataFrame, table: VersionedTable, load: Callable[[datetime], DataFrame], checkpoint: str,
               trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Renew the table at every tick of a clock; a micro-batch with several ticks renews once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        millis = batch.agg(F.max(F.unix_millis("timestamp"))).first()[0]
        if millis is not None:
            now = datetime.fromtimestamp(millis // 1000, timezone.utc).replace(microsecond=millis % 1000 * 1000)
            table.refresh(load(now), now)

    return start(ticks, run, checkpoint, trigger, name)
