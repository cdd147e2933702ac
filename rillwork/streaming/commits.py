"""Several tables written by one stream, as one commit per micro-batch.

The rows of a micro-batch are staged below each table under the batch's id. Then one file appears in the log
(renamed into place) and makes all of them part of the tables at once. What is staged but not in the log does
not count: a batch that a lost driver left half done is staged anew, a batch in the log is skipped. So every row is in
every table once, and no reader sees one table ahead of another. Every ``COMPACT`` batches the log is
rewritten into one file.

    root/<table>/batch=5/...       root/_log/000000000005.json      root/_log/000000000009.all.json
"""

from __future__ import annotations

import json
import re
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillwork.sources import files
from rillwork.streaming import sinks

COMPACT = 10
_NAME = re.compile(r"(\d{12})(\.all)?\.json")


class CommitLog:
    """Entries are {"batch": id, "tables": [names with rows]}."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_log"
        self.entries: list[dict] = []
        self.tables: dict[str, dict] = {}
        found = [(int(m[1]), bool(m[2]), m[0]) for n in files.names(spark, self.folder) if (m := _NAME.fullmatch(n))]
        whole = max((f for f in found if f[1]), default=None)
        for f in sorted(f for f in found if f == whole or (not f[1] and (whole is None or f[0] > whole[0]))):
            self._take(json.loads(files.text(spark, f"{self.folder}/{f[2]}")))
        self._loose = [f for f in found if f != whole]

    def _take(self, content: dict) -> None:
        self.entries += content["entries"]
        self.tables |= content["tables"]

    @property
    def last(self) -> int:
        return self.entries[-1]["batch"] if self.entries else -1

    def publish(self, batch_id: int, schemas: dict[str, T.StructType], filled: list[str], **more) -> None:
        entry = {"entries": [{"batch": batch_id, "tables": filled, **more}],
                 "tables": {n: s.jsonValue() for n, s in schemas.items()}}
        files.publish(self.spark, f"{self.folder}/{batch_id:012d}.json", json.dumps(entry))
        self._take(entry)
        self._loose.append((batch_id, False, f"{batch_id:012d}.json"))
        if len(self._loose) >= COMPACT:
            self._compact()

    def _compact(self) -> None:
        name = f"{self.last:012d}.all.json"
        if name not in files.names(self.spark, self.folder):
            files.publish(self.spark, f"{self.folder}/{name}",
                          json.dumps({"entries": self.entries, "tables": self.tables}))
        for f in files.names(self.spark, self.folder):
            if f != name:
                files.remove(self.spark, f"{self.folder}/{f}")
        self._loose = []


def committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a table that the log knows."""
    root, log = root.rstrip("/"), CommitLog(spark, root)
    if table not in log.tables:
        raise ValueError(f"no table {table!r} was committed below {root}")
    schema = T.StructType.fromJson(log.tables[table])
    folders = [f"{root}/{table}/batch={e['batch']}" for e in log.entries if table in e["tables"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
            .option("basePath", f"{root}/{table}").parquet(*folders).select(*schema.names))


def _stage(batch: DataFrame, batch_id: int, branches: list[sinks.Branch], root: str):
    """Write the branches of a micro-batch below their tables: (schemas, names of tables with rows)."""
    spark, schemas, filled = batch.sparkSession, {}, []
    for b in branches:
        folder = f"{root}/{b.target}/batch={batch_id}"
        files.remove(spark, folder)
        rows = b.rows(batch)
        schemas[b.target] = sinks.stored_schema(rows, b.schema, b.partition_by)
        sinks.append(rows, folder, b.schema, partition_by=b.partition_by)
        if files.names(spark, folder):
            filled.append(b.target)
    return schemas, filled


def write_together(stream: DataFrame, branches: list[sinks.Branch], root: str, checkpoint: str,
                   trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Fan out one scan to tables below ``root`` (a branch's target is a name), one commit per micro-batch."""
    root = root.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, root)
        if batch_id <= log.last:
            return
        batch.persist()
        try:
            log.publish(batch_id, *_stage(batch, batch_id, branches, root))
        finally:
            batch.unpersist()

    return sinks.start(stream, run, checkpoint, trigger, name)


def write_split_late(stream: DataFrame, time_col: str, delay: timedelta, root: str, checkpoint: str,
                     trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Rows in time to the table ``on_time``, late ones to the table ``late`` with ``late_by`` (seconds behind the
    watermark), in one commit.

    The watermark of a micro-batch is the newest time of all micro-batches before it, less ``delay``; rows at
    or before it are late. It is kept in the log, so a restart judges as the first run did. Put stateful queries
    behind ``on_time``: they drop nothing then. Rows without time are late, with ``late_by`` null.
    """
    root = root.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, root)
        if batch_id <= log.last:
            return
        newest = log.entries[-1]["newest"] if log.entries else None
        batch.persist()
        try:
            behind = F.lit(0)
            if newest is not None:
                behind = F.lit(newest - delay // timedelta(microseconds=1)) - F.unix_micros(time_col)
            is_late = F.col(time_col).isNull() | (behind >= 0 if newest is not None else F.lit(False))
            branches = [sinks.Branch(lambda df: df.where(~is_late), "on_time"),
                        sinks.Branch(lambda df: df.where(is_late).withColumn(
                            "late_by", F.when(F.col(time_col).isNotNull(), behind / 1e6)), "late")]
            staged = _stage(batch, batch_id, branches, root)
            top = batch.agg(F.max(F.unix_micros(time_col))).first()[0]
            seen = [t for t in (newest, top) if t is not None]
            log.publish(batch_id, *staged, newest=max(seen) if seen else None)
        finally:
            batch.unpersist()

    return sinks.start(stream, run, checkpoint, trigger, name)
