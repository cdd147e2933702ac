"""Lookups that are renewed while a stream runs. Each is called with a micro-batch.

Use them with ``sinks.write_each``. The dimension is kept as a written table in the shared folder,
so losing executors costs nothing and each micro-batch reads it ready deduplicated.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rillwork.operators.aggregate import PROFILE_ORDER, colwise_max, latest_profiles
from rillwork.operators.join import PROFILE_COLS, join_profiles
from rillwork.operators.lookup import VERSION_COLS, all_profiles, enrich_lookup
from rillwork.session import remove, shared_dir
from rillwork.sources.buckets import BucketedTable
from rillwork.streaming.sinks import start

Load = Callable[[], DataFrame]


class RefreshingLookup:
    """Snapshot renewed when it is older than ``every`` seconds (``None``: never again).

    Each renewal writes a new copy. The copy before is kept, because a micro-batch that started with
    it may still run; older ones are removed.
    """

    def __init__(self, load: Load, every: float | None = 1800.0,
                 clock: Callable[[], float] = time.monotonic):
        self.load, self.every, self.clock = load, every, clock
        self.loads = 0
        self._dim: DataFrame | None = None
        self._loaded_at = 0.0
        self._copies: list[str] = []

    def dimension(self) -> DataFrame:
        now = self.clock()
        stale = self._dim is not None and (self.every is not None
                                           and now - self._loaded_at >= self.every)
        if self._dim is None or stale:
            rows = latest_profiles(self.load())
            spark = rows.sparkSession
            path = shared_dir(spark, "profiles")
            rows.write.parquet(path)
            self._dim = spark.read.schema(rows.schema).parquet(path)
            self._loaded_at, self.loads = now, self.loads + 1
            self._copies.append(path)
            while len(self._copies) > 2:
                remove(spark, self._copies.pop(0))
        return self._dim

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return join_profiles(batch, self.dimension())


class SqlLookup:
    """Snapshot and updates read anew for each micro-batch, united and reduced per user."""

    def __init__(self, load_snapshot: Load, load_updates: Load, dedup: str = "colwise_max"):
        self.load_snapshot, self.load_updates = load_snapshot, load_updates
        self.one_per_user = {"colwise_max": lambda df: colwise_max(df, ["user_id"]),
                             "latest": latest_profiles}[dedup]

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        versions = all_profiles(self.load_snapshot(), self.load_updates())
        return join_profiles(batch, self.one_per_user(versions))


class ExternalLookup:
    """The table is read for every micro-batch, but only for the users that occur in it."""

    def __init__(self, load: Load, default: dict[str, str] | None = None):
        self.load, self.default = load, default

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return enrich_lookup(batch, self.load(), self.default)


class BucketedLookup:
    """The newest version of a bucketed table, of which only the buckets and row groups with the
    micro-batch's users are read."""

    def __init__(self, path: str, default: dict[str, str] | None = None):
        self.path, self.default = path, default

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        table = BucketedTable(batch.sparkSession, self.path)
        out = join_profiles(batch, table.of_keys(batch.select("user_id")))
        default = self.default or {}
        return out.select(*[F.coalesce(c, F.lit(default[c])).alias(c) if c in default else F.col(c)
                            for c in out.columns])


def keep_latest(updates: DataFrame, table: BucketedTable, checkpoint: str, trigger: dict | None = None,
                name: str | None = None) -> StreamingQuery:
    """A bucketed table that follows a stream of profile versions: the latest per user stays.

    One stream per table: micro-batch n makes version n + 1, so a repeated one changes nothing. State is the table
    itself; the result does not depend on how the input falls into micro-batches.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            BucketedTable(batch.sparkSession, table.path).merge_latest(
                latest_profiles(batch), PROFILE_ORDER, batch_id + 1)
        finally:
            batch.unpersist()

    return start(updates, run, checkpoint, trigger, name)


@dataclass(frozen=True)
class Segment:
    """Cache entries that were written together; with more than one bucket, in a folder per bucket."""

    path: str
    rows: int
    buckets: int
    newest: datetime


class CachedLookup:
    """A cache of found profiles with expiry, between the stream and the table.

    All rows of a micro-batch share one clock reading. A profile is good while
    now < fetch time + ttl; users without a good profile are looked up in the table; a miss is not
    kept. The profiles that a micro-batch fetches are a segment of their own. A segment at least half as large as the
    one before is merged with it, without expired entries, so there are about log2(entries) segments and an
    entry is rewritten about as often. Segments have a bucket per ``bucket_rows`` entries, users dealt by hash, and
    a micro-batch reads the buckets of its users. A segment that has expired as a whole is dropped unread. A
    repeated batch starts from the segments before it; folders that neither it nor the next batch can need are
    removed. After a restart the cache is empty and fills anew.
    """

    SCHEMA = ("user_id string, fetched_at timestamp, username string, user_segment string, "
              "registration_date string")

    def __init__(self, load: Load, ttl: timedelta, path: str,
                 clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
                 bucket_rows: int = 250_000):
        self.load, self.ttl, self.clock, self.bucket_rows = load, ttl, clock, bucket_rows
        self.path = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
        self.written = 0
        self._after: dict[int, list[Segment]] = {}

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")

    def _buckets_for(self, rows: int) -> int:
        """A power of two, so that the bucket of a smaller segment follows from that of a larger one."""
        return 1 << (-(-rows // self.bucket_rows) - 1).bit_length() if rows else 1

    def _stored(self, spark: SparkSession, segments: list[Segment], touched: set[int] | None = None) -> DataFrame:
        """Entries of the segments; of the buckets that ``touched`` ones fall into, if given."""
        out = spark.createDataFrame([], self.SCHEMA)
        for s in segments:
            if s.buckets == 1:
                out = out.unionByName(spark.read.schema(self.SCHEMA).parquet(s.path))
                continue
            rows = spark.read.schema(f"{self.SCHEMA}, bucket int").parquet(s.path)
            if touched is not None:
                rows = rows.where(F.col("bucket").isin(sorted({b % s.buckets for b in touched})))
            out = out.unionByName(rows.drop("bucket"))
        return out

    def _written(self, rows: DataFrame, path: str, buckets: int, newest: datetime) -> Segment:
        spark = rows.sparkSession
        if buckets == 1:
            rows.write.mode("overwrite").parquet(path)
        else:
            dealt = rows.withColumn("bucket", self._bucket(buckets)).repartition("bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        count = spark.read.schema(self.SCHEMA).parquet(path).count()
        self.written += count
        return Segment(path, count, buckets, newest)

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark, now = batch.sparkSession, self.clock()
        earlier = max((i for i in self._after if i < batch_id), default=None)
        before = self._after.get(earlier, [])
        live = [s for s in before if now < s.newest + self.ttl]
        good = F.col("fetched_at") > F.lit(now) - F.lit(self.ttl)
        users = batch.select("user_id").where("user_id is not null").distinct()
        most = max((s.buckets for s in live), default=1)
        touched = {r[0] for r in users.select(self._bucket(most)).distinct().collect()} if most > 1 else {0}
        missing = users.join(self._stored(spark, live, touched).where(good), "user_id", "left_anti")
        wanted = self.load().select(*VERSION_COLS).join(missing, "user_id", "left_semi")
        found = latest_profiles(wanted).select("user_id", F.lit(now).alias("fetched_at"), *PROFILE_COLS)
        new = self._written(found, f"{self.path}/new={batch_id}", 1, now)
        kept, merged, rows = list(live), [], new.rows
        while new.rows and kept and 2 * rows >= kept[-1].rows:
            merged.append(kept.pop())
            rows += merged[-1].rows
        buckets = self._buckets_for(rows)
        if merged or buckets > 1:
            new = self._written(self._stored(spark, [*merged, new]).where(good), f"{self.path}/batch={batch_id}",
                                buckets, now)
        after = [*kept, new] if new.rows else kept
        self._settle(spark, before, earlier, after, batch_id)
        most = max((s.buckets for s in after), default=1)
        touched = {r[0] for r in users.select(self._bucket(most)).distinct().collect()} if most > 1 else {0}
        return join_profiles(batch, self._stored(spark, after, touched).where(good))

    def _settle(self, spark: SparkSession, before: list[Segment], earlier: int | None, after: list[Segment],
                batch_id: int) -> None:
        """Note what the batch leaves, and remove what only batches before the last can have needed."""
        known = {s.path for segments in self._after.values() for s in segments}
        known |= {f"{self.path}/new={batch_id}"}
        self._after = {batch_id: after} if earlier is None else {earlier: before, batch_id: after}
        needed = {s.path for segments in self._after.values() for s in segments}
        for path in known - needed:
            remove(spark, path)
