"""Registered streaming queries: the given tables replayed as topics, end to end.

The messages are stored in time order, a slice of ``SLICE`` days after the other, and read with bounded
micro-batches. A slice's files may come in any order, so a row is at most ``SLICE`` days late; the
watermark delay covers that, state is given up behind it, and the replay has the results of a batch. A last
message, later than all data by more than the delay, closes every window. Its rows are told apart by
their time: the latest time of the data is known, and no data row is later.
"""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork import schemas as S
from rillwork.functions import window_of
from rillwork.operators import aggregate as agg, join as jn, lookup as lk, parse as ps, sqlfile
from rillwork.plans import inputs as src
from rillwork.plans.catalog import plain_times, stored_rows_of
from rillwork.plans.jobs import BranchedJob, MultiTopicJob, TemplateJob, wait
from rillwork.session import apply_defaults, shared_dir
from rillwork.sources import tables, topics
from rillwork.sources.buckets import BucketedTable
from rillwork.streaming import commits, sinks
from rillwork.streaming.cells import enrich_expiring_stream, enrich_hybrid_stream, enrich_sql_stream
from rillwork.streaming.counters import CounterTable, counted
from rillwork.streaming.lookups import BucketedLookup, CachedLookup, RefreshingLookup, keep_latest
from rillwork.streaming.versions import VersionedTable, clock, refresh_on

REPLAYS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SLICE = 10
DELAY = f"{SLICE + 1} days"
#: Least files of a slice, and of a micro-batch: one slice after the other. A file is written and read by one
#: task, so there are as many as cores.
FILES_PER_TRIGGER = 4
CLOSING = {
    "user-events": {"event_id": "end", "user_id": "end", "event_type": "end", "product_id": "end"},
    "product-updates": {"product_id": "end", "product_name": "end", "price": 0, "category": "end"},
    "user-profiles": {"user_id": "end", "username": "end", "user_segment": "end",
                      "registration_date": "2000-01-01"},
}
MESSAGES = {"user-events": src.event_messages, "product-updates": src.product_messages,
            "user-profiles": src.profile_messages}


def replay(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(fn(apply_defaults(spark), sf_dir))

    REPLAYS[fn.__name__] = run
    return run


class _Replay:
    """Topics made of the given tables, and a folder for what a job writes."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.dir = shared_dir(spark, name)
        first, last = src.event_messages(spark, sf_dir).agg(
            F.min("timestamp"), F.max("timestamp")).first()
        self.first, self.last = first or datetime(2000, 1, 1), last or datetime(2000, 1, 1)
        self.end = self.last + timedelta(days=2 * (SLICE + 1))
        self.stored: set[str] = set()
        self.files = max(FILES_PER_TRIGGER, spark.sparkContext.defaultParallelism)

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def topic(self, spark: SparkSession, name: str) -> DataFrame:
        """A topic as a stream; stored on first use."""
        if name not in self.stored:
            self._store(name)
            self.stored.add(name)
        return topics.replay_stream(spark, self.path(name), maxFilesPerTrigger=str(self.files))

    def _store(self, name: str) -> None:
        messages = MESSAGES[name](self.spark, self.sf_dir)
        start = self.first
        while start <= self.last:  # by days of the data, not by rows
            end = start + timedelta(days=SLICE)
            part = messages.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
            part.repartition(self.files, "offset").write.mode("append").parquet(self.path(name))
            start = end
        value = json.dumps({**CLOSING[name], "timestamp": self.end.isoformat()})
        closing = self.spark.range(1).select(
            F.lit("end").alias("key"), F.lit(value).alias("value"), F.lit(name).alias("topic"),
            F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.lit(self.end).alias("timestamp"))
        topics.envelope(closing).write.mode("append").parquet(self.path(name))

    def job(self, kind, **options):
        """Run a job over the topics to their end."""
        wait(kind(checkpoint=self.path("checkpoints"), trigger=sinks.AVAILABLE_NOW,
                  open_topic=self.topic, **options).start(self.spark))

    def rows(self, kind: str) -> DataFrame:
        parse, name = {"events": (ps.parse_events, "user-events"),
                       "products": (ps.parse_products, "product-updates"),
                       "updates": (ps.parse_profiles, "user-profiles")}[kind]
        return parse(self.topic(self.spark, name), "fail").rows

    def run(self, df: DataFrame, time_col: str) -> DataFrame:
        sinks.append(df, self.path("out"), checkpoint=self.path("checkpoint"),
                     trigger=sinks.AVAILABLE_NOW).awaitTermination()
        return self.read("out", time_col)

    def read(self, name: str, time_col: str) -> DataFrame:
        """What was written, without the closing message's rows."""
        return self.spark.read.parquet(self.path(name)).where(F.col(time_col) <= F.lit(self.last))


def _profiles(spark, sf, r):
    """The stored profile table, written in the sink's schema as a job would."""
    rows = stored_rows_of(spark, sf).withColumn("processing_time", F.current_timestamp())
    sinks.append(rows, r.path("profiles"), S.USER_PROFILES)
    return r.path("profiles")


@replay
def stream_events_per_minute(spark, sf):
    r = _Replay(spark, sf, "counts")
    return r.run(agg.count_by_window(r.rows("events"), delay=DELAY), "window_start")


@replay
def stream_enriched_events(spark, sf):
    r = _Replay(spark, sf, "enriched")
    r.job(MultiTopicJob, user_events_topic="user-events", product_updates_topic="product-updates",
          user_profiles_topic="user-profiles", user_profiles_table=_profiles(spark, sf, r),
          enriched_events_table=r.path("out"), width="1 hour", delay=DELAY,
          lookup=RefreshingLookup(lambda: stored_rows_of(spark, sf), None))
    return r.read("out", "event_timestamp").drop("processing_time", "processing_time_day").withColumn(
        "registration_date", F.col("registration_date").cast("date"))


@replay
def stream_refreshing_lookup(spark, sf):
    """The profiles are read anew for each micro-batch (they do not change, so results do not either)."""
    r = _Replay(spark, sf, "refreshing")
    stream = r.rows("events")
    lookup = RefreshingLookup(lambda: stored_rows_of(spark, sf), 0.0)
    sinks.write_each(stream, lookup, r.path("out"), r.path("checkpoint"),
                     trigger=sinks.AVAILABLE_NOW).awaitTermination()
    return r.read("out", "event_time")


@replay
def stream_cached_lookup(spark, sf):
    """Each micro-batch is 40 minutes after the one before: entries expire with the second, are fetched again and
    are the same again, so each event has its user's latest profile."""
    r = _Replay(spark, sf, "cached")
    ticks = itertools.count()
    lookup = CachedLookup(lambda: stored_rows_of(spark, sf), timedelta(hours=1), r.path("cache"),
                          lambda: datetime(2030, 1, 1) + timedelta(minutes=40) * next(ticks))
    sinks.write_each(r.rows("events"), lookup, r.path("out"), r.path("checkpoint"),
                     trigger=sinks.AVAILABLE_NOW).awaitTermination()
    return r.read("out", "event_time")


@replay
def stream_hybrid(spark, sf):
    r = _Replay(spark, sf, "hybrid")
    rows = enrich_hybrid_stream(r.rows("events"), r.rows("updates"), stored_rows_of(spark, sf),
                                delay=DELAY)
    return r.run(rows, "event_time")


@replay
def stream_three_way(spark, sf):
    r = _Replay(spark, sf, "three-way")
    profiles = RefreshingLookup(lambda: lk.all_profiles(
        stored_rows_of(spark, sf), ps.parse_profiles(src.profile_messages(spark, sf)).rows), None)
    rows = jn.three_way(r.rows("events"), r.rows("products"), profiles.dimension(), "1 hour",
                        delay=DELAY)
    return r.run(rows, "event_time")


@replay
def stream_sql_live(spark, sf):
    """Each event with its user's column maxima over the stored profiles and the live updates up to
    its time, and with the products of its hour: two stateful operators, one after the other."""
    r = _Replay(spark, sf, "sql-live")
    seen = enrich_sql_stream(r.rows("events"), r.rows("updates"), stored_rows_of(spark, sf), delay=DELAY)
    rows = jn.left_join_in_window(seen, r.rows("products"), "1 hour", DELAY, marked=True)
    return r.run(rows.select("event_id", "user_id", "event_type", "product_id", "event_time",
                             F.col("_p_product_name").alias("product_name"),
                             F.col("_p_category").alias("category"), "username", "user_segment"), "event_time")


#: Long against the gaps between a user's events, short against the time that updates span.
TTL = timedelta(days=5)


def _expiring(spark, sf, name):
    """Updates are the table behind the cache, so it changes all the time."""
    r = _Replay(spark, sf, name)
    rows = enrich_expiring_stream(r.rows("events"), r.rows("updates"), int(TTL.total_seconds() * 1000), delay=DELAY)
    return r.run(rows, "event_time")


@replay
def stream_cached_profiles(spark, sf):
    return _expiring(spark, sf, "expiring").where("cache <> 'expired'")


@replay
def stream_cache_counts(spark, sf):
    """Hits, fetches, misses and expired entries per day."""
    return _expiring(spark, sf, "expiry").groupBy(F.to_date("event_time").alias("day"), "cache").agg(
        F.count(F.lit(1)).alias("n"))


@replay
def stream_lookup_metrics(spark, sf):
    """What the expiring cache counted while the stream ran, summed over its micro-batches."""
    r = _Replay(spark, sf, "metrics")
    table = CounterTable(spark, r.path("counters"))
    spark.streams.addListener(table)
    try:
        rows = enrich_expiring_stream(r.rows("events"), r.rows("updates"), int(TTL.total_seconds() * 1000),
                                      delay=DELAY)
        q = sinks.append(counted(rows, cache_col="cache"), r.path("out"), checkpoint=r.path("checkpoint"),
                         trigger=sinks.AVAILABLE_NOW)
        q.awaitTermination()
        for _ in range(600):  # the listener is told a moment later
            if str(q.runId) in table.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(table)
    names = ("lookups", "hits", "fetches", "misses", "expired", "late")
    return table.rows().agg(*[F.sum(n).alias(n) for n in names])


#: The dimension of the refreshed lookup: renewed so often, and who is still in it.
TICK, STAYS = timedelta(days=5), timedelta(days=15)


@replay
def stream_refreshed_profiles(spark, sf):
    """A clock renews a dimension (updates of the last 15 days) every 5 days, by differences; events see the
    version of their time. Profiles change, come and go between ticks."""
    r = _Replay(spark, sf, "refreshed")
    updates = ps.parse_profiles(src.profile_messages(spark, sf)).rows
    schema = updates.select("user_id", *jn.PROFILE_COLS).schema
    table = VersionedTable(spark, r.path("versions"), schema)

    def load(now):
        recent = (F.col("timestamp") <= F.lit(now)) & (F.col("timestamp") > F.lit(now - STAYS))
        return agg.latest_profiles(updates.where(recent)).select("user_id", *jn.PROFILE_COLS)

    ticks = clock(spark, int(TICK.total_seconds()), r.first)
    for _ in range((r.last - r.first) // TICK + 1):
        refresh_on(ticks, table, load, r.path("ticks"), sinks.AVAILABLE_NOW).awaitTermination()
    sinks.write_each(r.rows("events"), lambda df, i: table.join(df, jn.PROFILE_COLS), r.path("out"),
                     r.path("checkpoint"), trigger=sinks.AVAILABLE_NOW).awaitTermination()
    return r.read("out", "event_time")


@replay
def stream_late_rows(spark, sf):
    """Error events arrive 15 days after their time, with a watermark 5 days behind. A slice of arrivals
    is one micro-batch."""
    r = _Replay(spark, sf, "late")
    ev = ps.parse_events(src.event_messages(spark, sf)).rows
    arrives = F.col("event_time") + F.when(F.col("event_type") == "error", F.expr("interval 15 days")).otherwise(
        F.expr("interval 0 days"))
    at = r.first
    while at <= r.last + timedelta(days=15):
        part = ev.where((arrives >= F.lit(at)) & (arrives < F.lit(at + timedelta(days=SLICE))))
        part.write.mode("append").parquet(r.path(f"arrivals/slice={(at - r.first).days:05d}"))
        stream = spark.readStream.schema(ev.schema).parquet(r.path("arrivals/*"))
        commits.write_split_late(stream, "event_time", timedelta(days=5), r.path("tables"), r.path("checkpoint"),
                                 sinks.AVAILABLE_NOW).awaitTermination()
        at += timedelta(days=SLICE)
    both = [commits.committed(spark, r.path("tables"), t).select(
        "event_id", "event_time", F.lit(t).alias("side")) for t in ("on_time", "late")]
    return both[0].unionByName(both[1])


# Query files -----------------------------------------------------------------------------------

@replay
def stream_sql_file_aggregation(spark, sf):
    """The bundled query over a stream with a watermark."""
    r = _Replay(spark, sf, "sql-counts")
    rows = r.rows("events").withWatermark("event_time", DELAY)
    return r.run(sqlfile.run_single_input(spark, "event_counts.sql", rows), "window_start")


@replay
def stream_sql_file_join(spark, sf):
    r = _Replay(spark, sf, "sql-join")
    placed = lambda df, col: df.withColumn("window_start", window_of(F.col(col), "1 hour")["start"]).withWatermark(
        "window_start", DELAY)
    return r.run(sqlfile.run_sql_file(spark, "events_with_products.sql", {
        "user_events": placed(r.rows("events"), "event_time"),
        "product_updates": placed(r.rows("products"), "timestamp")}), "event_timestamp")


@replay
def stream_external_lookup(spark, sf):
    r = _Replay(spark, sf, "external")
    default = {"username": "unknown", "user_segment": "unknown"}
    BucketedTable.create(r.path("table"), agg.latest_profiles(stored_rows_of(spark, sf)))
    lookup = BucketedLookup(r.path("table"), default)
    sinks.write_each(r.rows("events"), lookup, r.path("out"), r.path("checkpoint"),
                     trigger=sinks.AVAILABLE_NOW).awaitTermination()
    return r.read("out", "event_time")


# Sinks -----------------------------------------------------------------------------------------

@replay
def stream_flat_events(spark, sf):
    r = _Replay(spark, sf, "flat")
    r.job(BranchedJob, topic="user-events", output_table=r.path("flat"), one_scan=False)
    return r.read("flat", "timestamp").drop("processing_time")


@replay
def stream_generic_by_day(spark, sf):
    """The generic table, read back from the second day of the data on: the day prunes partitions."""
    r = _Replay(spark, sf, "generic")
    r.job(TemplateJob, topic="user-events", output_table=r.path("generic"))
    day = (r.first + timedelta(days=1)).date()
    return r.read("generic", "event_time").where(F.col("event_time_day") >= F.lit(day)).select(
        "event_time", "payload")


@replay
def stream_profiles(spark, sf):
    r = _Replay(spark, sf, "profiles")
    r.job(MultiTopicJob, user_profiles_topic="user-profiles", user_profiles_table=r.path("table"))
    return r.read("table", "timestamp").drop("processing_time")


@replay
def stream_profiles_latest(spark, sf):
    """A table of the latest profile per user: the stored ones, kept up to date by the live updates."""
    r = _Replay(spark, sf, "latest")
    table = BucketedTable.create(r.path("table"), agg.latest_profiles(stored_rows_of(spark, sf)))
    keep_latest(r.rows("updates"), table, r.path("checkpoint"), sinks.AVAILABLE_NOW).awaitTermination()
    return BucketedTable(spark, r.path("table")).rows().where(F.col("timestamp") <= F.lit(r.last))


@replay
def stream_fan_out_committed(spark, sf):
    """As ``stream_fan_out``, but each micro-batch is one commit of all three tables."""
    r = _Replay(spark, sf, "committed")
    _fan_out(spark, sf, r, "flat", "generic", "rejects", r.path("tables"))
    return _per_kind(*[commits.committed(spark, r.path("tables"), t) for t in ("flat", "generic", "rejects")])


@replay
def stream_fan_out(spark, sf):
    """One scan to flat events, payloads and rejects; rows of each per event type and day. A third of the
    messages is damaged in ways that depend on the event type."""
    r = _Replay(spark, sf, "fan-out")
    _fan_out(spark, sf, r, *map(r.path, ("flat", "generic", "rejects")))
    return _per_kind(*[spark.read.parquet(r.path(p)) for p in ("flat", "generic", "rejects/damaged")])


def _fan_out(spark, sf, r, flat, generic, rejects, commit_root=None):
    src.damaged_messages(spark, sf).write.parquet(r.path("damaged"))
    wait(BranchedJob(
        topic="damaged", output_table=flat, generic_output_table=generic, quarantine=rejects,
        checkpoint=r.path("checkpoints"), trigger=sinks.AVAILABLE_NOW, commit_root=commit_root,
        open_topic=lambda s, t: topics.replay_stream(
            s, r.path("damaged"), maxFilesPerTrigger=str(FILES_PER_TRIGGER))).start(spark))


def _per_kind(flat, generic, rejects):
    kinds = [flat.select(F.lit("flat").alias("kind"), "event_type"),
             generic.select(F.lit("generic").alias("kind"),
                            F.get_json_object("payload", "$.event_type").alias("event_type")),
             rejects.select(F.lit("reject").alias("kind"), F.col("error").alias("event_type"))]
    every = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return every.groupBy("kind", "event_type").agg(F.count(F.lit(1)).alias("messages"))


@replay
def stored_profiles_scan(spark, sf):
    """The profile table, written and read back through the table scan."""
    r = _Replay(spark, sf, "scan")
    return tables.to_profile_rows(tables.table_scan(spark, _profiles(spark, sf, r))).rows
