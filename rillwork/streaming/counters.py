"""Counters of running lookups, one row per micro-batch.

Counts are taken while the rows pass (``observe``), so they cost no job. A listener writes what each
micro-batch reports to a folder of JSON files that any query can read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from rillwork.sources import files

METRICS = "lookup_counters"
SCHEMA = ("query string, run string, batch_id bigint, lookups bigint, hits bigint, misses bigint, fetches bigint, "
          "expired bigint, late bigint, rows_per_second double, batch_ms bigint")


def counted(df: DataFrame, matched_col: str = "username", cache_col: str | None = None) -> DataFrame:
    """The stream, with its lookups counted. ``cache_col`` holds what a cache did (hit, fetch, miss, expired)."""
    if cache_col is None:
        found = F.col(matched_col).isNotNull()
        return df.observe(METRICS, F.count(F.lit(1)).alias("lookups"), F.count_if(found).alias("hits"),
                          F.count_if(~found).alias("misses"))
    did = lambda kind: F.count_if(F.col(cache_col) == kind)
    return df.observe(METRICS, F.count_if(F.col(cache_col) != "expired").alias("lookups"), did("hit").alias("hits"),
                      did("miss").alias("misses"), did("fetch").alias("fetches"), did("expired").alias("expired"))


class CounterTable(StreamingQueryListener):
    """Appends the counters of every counted query in the session to ``path``; add it with
    ``spark.streams.addListener``. A micro-batch that is run again replaces nothing: it has one row per run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(METRICS)
        if seen is None:
            return
        row = {"query": p.name, "run": str(p.runId), "batch_id": p.batchId, **seen.asDict(),
               "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               "rows_per_second": p.processedRowsPerSecond, "batch_ms": p.batchDuration}
        name = f"{self.path}/{p.runId}-{p.batchId:012d}.json"
        if name.rsplit("/", 1)[1] not in files.names(self.spark, self.path):
            files.publish(self.spark, name, json.dumps(row))

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)
