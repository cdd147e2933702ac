"""A keyed table whose rows are found without reading all of it.

Keys are dealt into buckets by hash, one folder each, and sorted inside, so Parquet's own minima and maxima tell
which row groups may hold a key. A manifest names the current folder of every bucket. A change writes
new folders of the touched buckets only, and one new manifest makes all of them current at once; readers that started
before keep the folders they know, because the last two versions stay.

    path/data/version=7/bucket=12/*.parquet      path/manifest/000000000007
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rillwork.operators.aggregate import latest_by
from rillwork.sources import files

#: Most keys of a request that are handed to the scan as a list; beyond, buckets are pruned and keys joined.
LISTED = 1000


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str):
        """Open the table's newest version."""
        self.spark, self.path = spark, path.rstrip("/")
        found = files.names(spark, f"{self.path}/manifest")
        if not found:
            raise FileNotFoundError(f"no bucketed table at {path}")
        self._load(json.loads(files.text(spark, f"{self.path}/manifest/{found[-1]}")))

    def _load(self, manifest: dict) -> None:
        self.version, self.key, self.buckets = manifest["version"], manifest["key"], manifest["buckets"]
        self.schema = T.StructType.fromJson(manifest["schema"])
        self.folders = {int(b): v for b, v in manifest["folders"].items()}

    @classmethod
    def create(cls, path: str, rows: DataFrame, key: str = "user_id", buckets: int = 64) -> BucketedTable:
        """Write a new table. ``rows`` have one row per key; choose ``buckets`` so that one is some 100 MB."""
        spark, table = rows.sparkSession, cls.__new__(cls)
        table.spark, table.path = spark, path.rstrip("/")
        manifest = {"version": 0, "key": key, "buckets": buckets, "folders": {},
                    "schema": T.StructType(rows.schema.fields).jsonValue()}
        table._load(manifest)
        table._publish(rows, 0)
        return table

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _publish(self, rows: DataFrame, version: int) -> None:
        folder = f"{self.path}/data/version={version}"
        (rows.withColumn("bucket", self.bucket_of(F.col(self.key))).repartition(F.col("bucket"))
         .sortWithinPartitions("bucket", self.key)
         .write.mode("overwrite").partitionBy("bucket").parquet(folder))
        written = [int(n.partition("=")[2]) for n in files.names(self.spark, folder)]
        folders = {**self.folders, **{b: version for b in written}}
        manifest = {"version": version, "key": self.key, "buckets": self.buckets,
                    "schema": self.schema.jsonValue(), "folders": folders}
        before = self.folders
        files.publish(self.spark, f"{self.path}/manifest/{version:012d}", json.dumps(manifest))
        self._load(manifest)
        self._forget(before)

    def _forget(self, before: dict[int, int]) -> None:
        """Remove manifests before the last two, and bucket folders that neither names."""
        manifests = files.names(self.spark, f"{self.path}/manifest")
        for name in manifests[:-2]:
            old = json.loads(files.text(self.spark, f"{self.path}/manifest/{name}"))["folders"]
            for bucket, version in old.items():
                if version not in (before.get(int(bucket)), self.folders.get(int(bucket))):
                    files.remove(self.spark, self._folder(int(bucket), version))
            files.remove(self.spark, f"{self.path}/manifest/{name}")

    def _folder(self, bucket: int, version: int) -> str:
        return f"{self.path}/data/version={version}/bucket={bucket}"

    def rows(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        wanted = self.folders if buckets is None else {b: self.folders[b] for b in buckets if b in self.folders}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(b, v) for b, v in sorted(wanted.items())])

    def of_key(self, value) -> DataFrame:
        """Rows of one key: one bucket's folder, and an equality that reaches the scan."""
        bucket = self.spark.range(1).select(self.bucket_of(F.lit(value))).first()[0]
        return self.rows([bucket]).where(F.col(self.key) == F.lit(value))

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """Rows of the keys of a one-column frame. The driver sees bucket numbers, and keys only if they are
        ``LISTED`` at most. Right also if all keys are asked for: then all buckets are read."""
        key = keys.columns[0]
        asked = keys.where(F.col(key).isNotNull()).distinct()
        few = [r[0] for r in asked.limit(LISTED + 1).collect()]
        if len(few) <= LISTED:
            numbers = self.spark.createDataFrame([(k,) for k in few], keys.schema) if few else asked.limit(0)
        else:
            numbers = asked
        buckets = [r[0] for r in numbers.select(self.bucket_of(F.col(key)).alias("b")).distinct().collect()]
        found = self.rows(buckets)
        if len(few) <= LISTED:
            return found.where(F.col(self.key).isin(few))
        return found.join(asked.select(F.col(key).alias(self.key)), self.key, "left_semi").select(*self.schema.names)

    def merge_latest(self, changes: DataFrame, order: list[str], version: int) -> None:
        """Keep the latest row per key of the table and ``changes``. Only touched buckets are read and written. A
        version that is already there is not written again; one that was half written is replaced."""
        if version <= self.version:
            return
        changes = changes.select(*self.schema.names)
        touched = [r[0] for r in changes.select(self.bucket_of(F.col(self.key)).alias("b")).distinct().collect()]
        if not touched:
            return
        both = self.rows(touched).unionByName(changes)
        self._publish(latest_by(both, [self.key], order), version)
