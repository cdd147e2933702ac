"""Registered batch queries: name -> function of (spark, folder of the given tables).

Each one starts from messages or stored rows that Spark derives from the given tables and runs
the library's operators over all of them. Wall-clock columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork import schemas as S
from rillwork.functions import day_of, window_of
from rillwork.functions.payload import Isolated
from rillwork.operators import (aggregate as agg, inspect as look, join as jn, lookup as lk,
                                parse as ps, sqlfile)
from rillwork.plans import inputs as src
from rillwork.session import apply_defaults, shared_dir
from rillwork.sources import tables, topics
from rillwork.sources.buckets import BucketedTable
from rillwork.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]

BATCH: dict[str, Query] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone and dates as text, the same for every client."""
    kinds = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.select(*[F.col(n).cast(kinds[t]).alias(n) if t in kinds else F.col(n)
                       for n, t in df.dtypes])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(fn(apply_defaults(spark), sf_dir))

    BATCH[fn.__name__] = run
    return run


def event_rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.parse_events(src.event_messages(spark, sf_dir)).rows


def product_rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.parse_products(src.product_messages(spark, sf_dir)).rows


def update_rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.parse_profiles(src.profile_messages(spark, sf_dir)).rows


def stored_rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.to_profile_rows(src.profile_table(spark, sf_dir)).rows


# Messages and sources ---------------------------------------------------------------------------

@query
def event_messages(spark, sf):
    return src.event_messages(spark, sf)


@query
def keyed_messages(spark, sf):
    rows = src.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", "event_id")
    return ps.to_messages(rows, "user_id")


@query
def topic_offsets(spark, sf):
    every = (src.event_messages(spark, sf).unionByName(src.product_messages(spark, sf))
             .unionByName(src.profile_messages(spark, sf)))
    chosen = look.select_topics(every, ["user-events", "user-profiles"])
    return chosen.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("messages"))


@query
def peek_messages(spark, sf):
    return look.peek(src.event_messages(spark, sf), 20, ["user-events"], pretty=False)


@query
def envelope_times(spark, sf):
    millis = src.event_messages(spark, sf).select("offset", F.unix_millis("timestamp")
                                                  .alias("timestamp"))
    return topics.from_epoch_millis(millis)


# Parsing ----------------------------------------------------------------------------------------

@query
def flatten_events(spark, sf):
    rows = ps.flatten_events(src.event_messages(spark, sf))
    return S.conform(rows, S.USER_EVENTS).drop("processing_time")


@query
def event_rows(spark, sf):
    return event_rows_of(spark, sf)


@query
def generic_events(spark, sf):
    return ps.generic_events(src.event_messages(spark, sf)).drop("processing_time")


@query
def payload_records(spark, sf):
    return ps.apply_payload_fn(src.event_messages(spark, sf)).drop("processing_time")


@query
def payload_variant(spark, sf):
    """The generic table with the payload as JSON (variant), written and read back by field."""
    rows = ps.parse_payload(src.event_messages(spark, sf)).rows
    path = shared_dir(spark, "variant")
    sinks.append(rows, path, S.GENERIC_JSON)
    field = lambda f: F.variant_get("payload", f"$.{f}", "string").alias(f)
    return spark.read.parquet(path).select("event_time", *map(field, ("event_id", "user_id", "product_id")))


def _record_with_product(text: str) -> str:
    """A user function: it fails on messages without a product."""
    import json
    data = json.loads(text)
    return json.dumps({"event_time": data["timestamp"], "payload": data["product_id"]})


@query
def payload_python(spark, sf):
    """Records and failures of a Python function over all messages."""
    done = ps.parse_payload(src.event_messages(spark, sf), Isolated(_record_with_product))
    nothing = F.lit(None).cast("string")
    rows = done.rows.select("event_time", F.col("payload").alias("product_id"), nothing.alias("error"))
    return rows.unionByName(done.rejects.select(
        F.col("timestamp").alias("event_time"), nothing.alias("product_id"), "error"))


@query
def strict_rejects(spark, sf):
    """Messages whose ids are numbers, where text is required."""
    bare = src.event_messages(spark, sf).withColumn(
        "value", F.when(F.get_json_object("value", "$.event_type") == "click",
                        F.regexp_replace("value", '"user_id":"([0-9]+)"', '"user_id":$1')).otherwise(F.col("value")))
    return ps.parse_events(bare, strict=True).rejects.select("offset", "error")


@query
def product_rows(spark, sf):
    return product_rows_of(spark, sf)


@query
def product_records(spark, sf):
    rows = ps.product_records(src.product_messages(spark, sf))
    return S.conform(rows, S.PRODUCT_UPDATES).drop("processing_time")


@query
def profile_rows(spark, sf):
    return update_rows_of(spark, sf)


@query
def profile_records(spark, sf):
    return ps.profile_records(src.profile_messages(spark, sf)).drop("processing_time")


@query
def table_profile_rows(spark, sf):
    return stored_rows_of(spark, sf)


@query
def quarantine_rows(spark, sf):
    rejects = ps.parse_events(src.damaged_messages(spark, sf)).rejects
    return rejects.select("offset", "value", "error")


@query
def quarantine_counts(spark, sf):
    rejects = ps.parse_events(src.damaged_messages(spark, sf)).rejects
    return rejects.groupBy("error").agg(F.count(F.lit(1)).alias("messages"))


@query
def undamaged_events(spark, sf):
    return ps.parse_events(src.damaged_messages(spark, sf)).rows


# Aggregates -------------------------------------------------------------------------------------

@query
def events_per_minute(spark, sf):
    return agg.count_by_window(event_rows_of(spark, sf))


@query
def events_per_hour(spark, sf):
    return agg.count_by_window(event_rows_of(spark, sf), width="1 hour")


@query
def aggregation_records(spark, sf):
    counts = agg.count_by_window(event_rows_of(spark, sf))
    return agg.aggregation_records(counts).drop("processing_time")


@query
def day_partitions(spark, sf):
    days = event_rows_of(spark, sf).select(day_of(F.col("event_time")).alias("day"))
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("events"))


@query
def profiles_union(spark, sf):
    return lk.all_profiles(stored_rows_of(spark, sf), update_rows_of(spark, sf))


@query
def profiles_latest(spark, sf):
    return agg.latest_profiles(stored_rows_of(spark, sf))


@query
def profiles_latest_with_updates(spark, sf):
    return agg.latest_profiles(lk.all_profiles(stored_rows_of(spark, sf),
                                               update_rows_of(spark, sf)))


@query
def profiles_colwise_max(spark, sf):
    return agg.colwise_max(lk.all_profiles(stored_rows_of(spark, sf), update_rows_of(spark, sf)),
                           ["user_id"])


@query
def products_latest(spark, sf):
    return agg.latest_by(product_rows_of(spark, sf), ["product_id"],
                         ["timestamp", "product_name", "price", "category"])


# Joins ------------------------------------------------------------------------------------------

def _joined(spark, sf, width, **kw):
    """The time is converted to the type it is returned in once per event, not for each of its pairs."""
    events = event_rows_of(spark, sf).withColumn("_plain", F.col("event_time").cast("timestamp_ntz"))
    rows = jn.join_in_window(events, product_rows_of(spark, sf), width, keep=["_plain"], **kw)
    return rows.withColumn("event_timestamp", F.col("_plain")).drop("_plain")


@query
def join_events_products_1m(spark, sf):
    return _joined(spark, sf, "1 minute")


@query
def join_events_products_1h(spark, sf):
    return _joined(spark, sf, "1 hour")


@query
def join_events_products_1d(spark, sf):
    return _joined(spark, sf, "1 day")


@query
def join_events_products_split(spark, sf):
    """Groups above two rows count as hot, so nearly all rows take the split path."""
    return _joined(spark, sf, "1 day", hot_rows=2)


def _enriched(spark, sf, width):
    known = lk.enrich_static(event_rows_of(spark, sf), stored_rows_of(spark, sf))
    rows = jn.join_in_window(known, product_rows_of(spark, sf), width, keep=jn.PROFILE_COLS)
    return jn.enriched_records(rows).drop("processing_time")


@query
def enriched_events(spark, sf):
    return _enriched(spark, sf, "1 hour")


@query
def enriched_events_1m(spark, sf):
    return _enriched(spark, sf, "1 minute")


def _three_way(spark, sf, dedup):
    return lk.enrich_sql(event_rows_of(spark, sf), product_rows_of(spark, sf),
                         stored_rows_of(spark, sf), update_rows_of(spark, sf), "1 hour", dedup)


@query
def enriched_three_way(spark, sf):
    return _three_way(spark, sf, "colwise_max")


@query
def enriched_three_way_latest(spark, sf):
    return _three_way(spark, sf, "latest")


# Dimension lookups ------------------------------------------------------------------------------

@query
def static_lookup(spark, sf):
    return lk.enrich_static(event_rows_of(spark, sf), update_rows_of(spark, sf))


@query
def hybrid_asof(spark, sf):
    return lk.enrich_hybrid(event_rows_of(spark, sf), stored_rows_of(spark, sf),
                            update_rows_of(spark, sf))


@query
def hybrid_asof_split(spark, sf):
    """Slices above two events count as hot."""
    return lk.enrich_hybrid(event_rows_of(spark, sf), stored_rows_of(spark, sf),
                            update_rows_of(spark, sf), hot_rows=2)


@query
def refreshing_lookup(spark, sf):
    return lk.enrich_refreshing(event_rows_of(spark, sf), update_rows_of(spark, sf))


@query
def refreshing_lookup_1d(spark, sf):
    return lk.enrich_refreshing(event_rows_of(spark, sf), update_rows_of(spark, sf), "1 day")


@query
def lookup_external(spark, sf):
    default = {"username": "unknown", "user_segment": "unknown"}
    return lk.enrich_lookup(event_rows_of(spark, sf), stored_rows_of(spark, sf), default)


@query
def point_lookup(spark, sf):
    """Profile of the user with the most events."""
    busiest = (src.read(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), "user_id").limit(1)
               .select(F.col("user_id").cast("string")))
    return lk.point_lookup(stored_rows_of(spark, sf), busiest.scalar())


@query
def bucketed_point_lookup(spark, sf):
    """The same profile from a bucketed table: one bucket is read, and the key reaches the scan."""
    busiest = (src.read(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), "user_id").select(F.col("user_id").cast("string")).first())
    user = busiest[0] if busiest else ""
    table = BucketedTable.create(shared_dir(spark, "bucketed"), agg.latest_profiles(stored_rows_of(spark, sf)))
    return lk.point_lookup(table.of_key(user), user)


@query
def fallback_chain(spark, sf):
    """Sign-ups first, then stored profiles, then a default. User ids are taken times 20, so that users
    with a sign-up, with a stored profile only, and with neither all occur."""
    shifted = event_rows_of(spark, sf).withColumn(
        "user_id", (F.col("user_id").cast("bigint") * 20).cast("string"))
    return lk.fallback(shifted, [("updates", update_rows_of(spark, sf)),
                                 ("snapshot", stored_rows_of(spark, sf))], {"username": "unknown"})


@query
def lookup_hit_rate(spark, sf):
    rows = lk.enrich_refreshing(event_rows_of(spark, sf), update_rows_of(spark, sf), "1 day")
    return agg.lookup_hit_rate(rows, "username")


# Newest rows and query files --------------------------------------------------------------------

@query
def latest_windows_top10(spark, sf):
    counts = agg.count_by_window(event_rows_of(spark, sf))
    return look.newest(counts, "window_start", 10, ("event_type",))


@query
def latest_windows_by_day(spark, sf):
    """The same rows from the stored, day-partitioned table, of which only the newest days are read."""
    path = shared_dir(spark, "counts")
    sinks.append(agg.count_by_window(event_rows_of(spark, sf)), path, partition_by="window_start")
    return look.newest_by_day(spark, path, "window_start_day", "window_start", 10, ("event_type",)).drop(
        "window_start_day")


@query
def latest_enriched_top10(spark, sf):
    return look.newest(_enriched(spark, sf, "1 hour"), "event_timestamp", 10,
                       ("event_id", "product_id", "price"))


@query
def sql_file_aggregation(spark, sf):
    return sqlfile.run_single_input(spark, "event_counts.sql", event_rows_of(spark, sf))


def _placed(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("window_start", window_of(F.col(time_col), "1 hour")["start"])


@query
def sql_file_join(spark, sf):
    return sqlfile.run_sql_file(spark, "events_with_products.sql", {
        "user_events": _placed(event_rows_of(spark, sf), "event_time"),
        "product_updates": _placed(product_rows_of(spark, sf), "timestamp")})


@query
def sql_file_three_way(spark, sf):
    """The text joins profiles to all matches: a hash table of a partition's profiles spares a sort of those."""
    return sqlfile.run_sql_file(spark, "events_products_profiles.sql", {
        "user_events": _placed(event_rows_of(spark, sf), "event_time"),
        "product_updates": _placed(product_rows_of(spark, sf), "timestamp"),
        "user_profiles": agg.latest_profiles(stored_rows_of(spark, sf)).hint("shuffle_hash")})
