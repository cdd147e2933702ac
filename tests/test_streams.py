"""Streams replayed from stored messages, compared with the batch operators."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import at, event, event_rows, messages, profile_rows, tuples
from rillwork import schemas as S
from rillwork.operators import aggregate as agg, join as jn, lookup as lk, parse as ps
from rillwork.plans import inputs as src, replays
from rillwork.plans.jobs import BranchedJob, MultiTopicJob, TemplateJob, wait
from rillwork.sources import tables, topics
from rillwork.streaming import sinks
from rillwork.streaming.cells import enrich_hybrid_stream
from rillwork.streaming.lookups import CachedLookup, ExternalLookup, RefreshingLookup, SqlLookup
from rillwork.streaming.state import enrich_cached_stream

FAR = datetime(2100, 1, 1)
NOW = sinks.AVAILABLE_NOW


def store(df, path, files=3):
    """Messages in ``files`` files of rising time, so that a replay has several micro-batches."""
    cuts = [i / files for i in range(1, files)]
    bounds = df.approxQuantile("offset", cuts, 0.0) if cuts else []
    low = None
    for high in [*bounds, None]:
        part = df
        part = part if low is None else part.where(F.col("offset") > low)
        part = part if high is None else part.where(F.col("offset") <= high)
        part.coalesce(1).write.mode("append").parquet(path)
        low = high


def close(spark, path, **fields):
    """A message far in the future, which lets every open window end."""
    value = {"timestamp": FAR.isoformat(), **fields}
    df = messages(spark, [json.dumps(value)], start=10**9)
    df.coalesce(1).write.mode("append").parquet(path)


def replay(spark, path):
    return topics.replay_stream(spark, path, maxFilesPerTrigger="1")


def run(df, tmp_path, name, **kw):
    out = str(tmp_path / f"out-{name}")
    q = sinks.append(df, out, checkpoint=str(tmp_path / f"cp-{name}"), trigger=NOW, **kw)
    assert q.awaitTermination(120), "the stream does not end"
    return df.sparkSession.read.parquet(out)


@pytest.fixture(scope="module")
def topic_dir(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("topics")
    made = {}
    for name, df, closing in [
            ("user-events", src.event_messages(spark, sf_dir),
             {"event_id": "end", "user_id": "end", "event_type": "end", "product_id": "end"}),
            ("product-updates", src.product_messages(spark, sf_dir),
             {"product_id": "end", "product_name": "end", "price": 0, "category": "end"}),
            ("user-profiles", src.profile_messages(spark, sf_dir), None)]:
        path = str(base / name)
        store(df, path)
        if closing:
            close(spark, path, **closing)
        made[name] = path
    return made


def test_counts_equal_batch(spark, sf_dir, topic_dir, tmp_path):
    rows = ps.parse_events(replay(spark, topic_dir["user-events"])).rows
    got = run(agg.count_by_window(rows), tmp_path, "counts")
    want = agg.count_by_window(ps.parse_events(src.event_messages(spark, sf_dir)).rows)
    assert tuples(got) == tuples(want)


def test_late_rows_are_dropped_by_streams_only(spark, tmp_path):
    # Spark judges lateness by the watermark of the micro-batch before last.
    path = str(tmp_path / "in")
    for i, when in enumerate([at(0), at(3600), at(3700), at(10)]):
        messages(spark, [event(i, time=when)], start=i).coalesce(1).write.mode("append").parquet(path)
    close(spark, path, event_id="end", user_id="end", event_type="end")
    rows = ps.parse_events(replay(spark, path)).rows
    got = run(agg.count_by_window(rows), tmp_path, "late").where("event_type = 'view'")
    batch = agg.count_by_window(ps.parse_events(topics.replay_batch(spark, path)).rows)
    assert got.agg(F.sum("event_count")).collect()[0][0] == 3
    assert batch.where("event_type = 'view'").agg(F.sum("event_count")).collect()[0][0] == 4


@pytest.mark.parametrize("spread", [1, 3])
def test_window_join_equals_batch(spark, sf_dir, topic_dir, tmp_path, spread):
    events = ps.parse_events(replay(spark, topic_dir["user-events"])).rows
    products = ps.parse_products(replay(spark, topic_dir["product-updates"])).rows
    joined = jn.join_in_window(events, products, "1 day", "1 day", spread=spread)
    got = run(joined, tmp_path, "join").where("event_id <> 'end'")
    want = jn.join_in_window(ps.parse_events(src.event_messages(spark, sf_dir)).rows,
                             ps.parse_products(src.product_messages(spark, sf_dir)).rows, "1 day")
    assert tuples(got) == tuples(want)


def test_restart_neither_loses_nor_repeats(spark, sf_dir, tmp_path):
    path, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    all_rows = src.event_messages(spark, sf_dir)
    store(all_rows.where("offset < 400"), path, 2)

    def once():
        flat = ps.flatten_events(replay(spark, path))
        sinks.append(flat, out, S.USER_EVENTS, cp, trigger=NOW).awaitTermination()

    once()
    first = spark.read.parquet(out).count()
    store(all_rows.where("offset >= 400"), path, 2)
    once()
    got = spark.read.parquet(out)
    assert first == 400
    assert got.count() == all_rows.count() == got.select("event_id").distinct().count()


def _job_options(tmp_path, topic_dir, **kw):
    return dict(checkpoint=str(tmp_path / "cp"), trigger=NOW,
                open_topic=lambda s, t: replay(s, topic_dir[t]), **kw)


@pytest.mark.parametrize("one_scan", [False, True])
def test_branched_job(spark, sf_dir, topic_dir, tmp_path, one_scan):
    out = {n: str(tmp_path / n) for n in ("flat", "generic", "counts", "bad")}
    job = BranchedJob(topic="user-events", output_table=out["flat"],
                      generic_output_table=out["generic"], aggregation_table=out["counts"],
                      quarantine=out["bad"], one_scan=one_scan,
                      **_job_options(tmp_path, topic_dir))
    running = job.start(spark)
    wait(running)
    assert len(running) == (2 if one_scan else 4)
    flat = spark.read.parquet(out["flat"]).where("event_id <> 'end'")
    want = ps.flatten_events(src.event_messages(spark, sf_dir)).drop("processing_time")
    assert tuples(flat.select(want.columns)) == tuples(want)
    generic = spark.read.parquet(out["generic"])
    assert generic.count() == flat.count() + 1 and "event_time_day" in generic.columns
    counts = spark.read.parquet(out["counts"]).where("event_type <> 'end'")
    assert counts.agg(F.sum("event_count")).collect()[0][0] == flat.count()
    assert set(S.EVENT_COUNTS.names) < set(counts.columns)


def test_branched_job_builds_only_what_is_set(spark, topic_dir, tmp_path):
    job = BranchedJob(topic="user-events", output_table=str(tmp_path / "flat"),
                      **_job_options(tmp_path, topic_dir))
    running = job.start(spark)
    wait(running)
    assert [q.name for q in running] == ["tables"]


def test_a_repeated_batch_is_written_once(spark, tmp_path):
    df, target, marker = messages(spark, [event(i) for i in range(5)]), *(str(tmp_path / n) for n in "tm")
    for batch_id in (7, 7, 8):
        sinks.write_batch(ps.flatten_events(df), batch_id, target, marker, S.USER_EVENTS)
    got = spark.read.parquet(target)
    assert got.count() == 10 and got.columns == S.USER_EVENTS.names


def test_per_batch_writers_take_catalog_tables(spark, topic_dir, tmp_path):
    job = BranchedJob(topic="user-events", output_table="job_flat", generic_output_table="job_generic",
                      **_job_options(tmp_path, topic_dir))
    wait(job.start(spark))
    flat, generic = spark.table("job_flat"), spark.table("job_generic")
    assert flat.count() == generic.count() > 0 and flat.columns == S.USER_EVENTS.names
    assert "event_time_day" in generic.columns
    ev = ps.parse_events(replay(spark, topic_dir["user-events"])).rows
    sinks.write_each(ev, lambda df, i: df, "job_rows", str(tmp_path / "cp2"), trigger=NOW
                     ).awaitTermination()
    assert spark.table("job_rows").count() == flat.count()


def test_a_bad_message_ends_a_job_without_quarantine(spark, tmp_path):
    path = str(tmp_path / "in")
    messages(spark, [event(0), "no json"]).coalesce(1).write.parquet(path)
    job = BranchedJob(topic="t", output_table=str(tmp_path / "flat"), checkpoint=str(tmp_path / "cp"),
                      trigger=NOW, open_topic=lambda s, t: replay(s, path))
    with pytest.raises(Exception, match="bad message"):
        wait(job.start(spark))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace
    from rillwork.session import shared_dir
    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(fake, "x")


@pytest.mark.parametrize("refresh", [None, 0.0])
def test_multi_topic_job(spark, sf_dir, topic_dir, tmp_path, refresh):
    out = {n: str(tmp_path / n) for n in ("profiles", "enriched")}
    ingest = MultiTopicJob(user_profiles_topic="user-profiles", user_profiles_table=out["profiles"],
                           **_job_options(tmp_path, topic_dir))
    running = ingest.start(spark)
    wait(running)
    assert [q.name for q in running] == ["user_profiles"]
    job = MultiTopicJob(user_events_topic="user-events", product_updates_topic="product-updates",
                        user_profiles_topic="user-profiles", user_profiles_table=out["profiles"],
                        enriched_events_table=out["enriched"], width="1 hour", delay="1 day",
                        refresh_seconds=refresh, **_job_options(tmp_path, topic_dir))
    wait(job.start(spark))
    got = spark.read.parquet(out["enriched"]).where("event_id <> 'end'")
    joined = jn.join_in_window(ps.parse_events(src.event_messages(spark, sf_dir)).rows,
                               ps.parse_products(src.product_messages(spark, sf_dir)).rows,
                               "1 hour")
    updates = ps.parse_profiles(src.profile_messages(spark, sf_dir)).rows
    want = jn.enriched_records(lk.enrich_static(joined, updates)).drop("processing_time")
    assert tuples(got.select(want.columns)) == tuples(want)
    assert "processing_time_day" in got.columns
    assert spark.read.parquet(out["profiles"]).count() == updates.count()


def test_template_job(spark, sf_dir, topic_dir, tmp_path):
    job = TemplateJob(topic="user-events", output_table=str(tmp_path / "t"),
                      **_job_options(tmp_path, topic_dir))
    assert job.kafka_read_offset == "earliest"
    wait(job.start(spark))
    got = spark.read.parquet(str(tmp_path / "t"))
    want = ps.generic_events(topics.replay_batch(spark, topic_dir["user-events"]))
    cols = ["event_time", "payload"]
    assert tuples(got.select(cols)) == tuples(want.select(cols))
    assert got.where("processing_time IS NULL").count() == 0


def test_rejects_reach_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "in")
    messages(spark, [event(0), "no json"]).coalesce(1).write.parquet(path)
    job = BranchedJob(topic="t", output_table=str(tmp_path / "flat"), checkpoint=str(tmp_path / "cp"),
                      trigger=NOW, quarantine=str(tmp_path / "bad"),
                      open_topic=lambda s, t: replay(s, path))
    wait(job.start(spark))
    bad = spark.read.parquet(str(tmp_path / "bad" / "t")).collect()
    assert [(r.value, r.error) for r in bad] == [("no json", "not a JSON object")]


def test_append_to_catalog_tables(spark, sf_dir):
    rows = ps.generic_events(src.event_messages(spark, sf_dir))
    for _ in range(2):
        sinks.append(rows, "raw_payloads", S.GENERIC, partition_by="event_time")
    got = tables.table_scan(spark, "raw_payloads")
    assert got.count() == 2 * rows.count()
    day = got.where("event_time_day = '2024-01-02'")
    assert "event_time_day" in day._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters")[1]


def test_refreshing_lookup_sees_new_rows_after_the_period(spark, tmp_path):
    table, now = str(tmp_path / "profiles"), [0.0]
    profile_rows(spark, [("a", "A1", "s", "d", at(0))]).write.parquet(table)
    lookup = RefreshingLookup(lambda: spark.read.parquet(table), 60, lambda: now[0])
    ev = event_rows(spark, [("e1", "a", "t", None, at(0)), ("e2", "b", "t", None, at(0))])
    names = lambda: [r.username for r in lookup(ev, 0).orderBy("event_id").collect()]
    assert names() == ["A1", None]
    profile_rows(spark, [("b", "B1", "s", "d", at(0))]).write.mode("append").parquet(table)
    now[0] = 59
    assert names() == ["A1", None] and lookup.loads == 1
    now[0] = 60
    assert names() == ["A1", "B1"] and lookup.loads == 2


def test_external_and_sql_lookup_are_fresh_each_batch(spark, tmp_path):
    table = str(tmp_path / "profiles")
    profile_rows(spark, [("a", "A1", "s", "d", at(0))]).write.parquet(table)
    load = lambda: spark.read.parquet(table)
    empty = lambda: profile_rows(spark, [])
    lookups = [ExternalLookup(load, {"username": "none"}), SqlLookup(load, empty),
               SqlLookup(empty, load, "latest")]
    ev = event_rows(spark, [("e1", "a", "t", None, at(0)), ("e2", "b", "t", None, at(0))])
    seen = lambda x: [r.username for r in x(ev, 0).orderBy("event_id").collect()]
    assert [seen(x) for x in lookups] == [["A1", "none"], ["A1", None], ["A1", None]]
    profile_rows(spark, [("b", "B1", "s", "d", at(0))]).write.mode("append").parquet(table)
    assert [seen(x) for x in lookups] == [["A1", "B1"]] * 3


def test_cached_lookup(spark, tmp_path):
    table, now = str(tmp_path / "profiles"), [at(0).replace(tzinfo=timezone.utc)]
    load = lambda: spark.read.parquet(table)
    profile_rows(spark, [("a", "A1", "s", "d", at(0))]).write.parquet(table)
    cache = CachedLookup(load, timedelta(minutes=10), str(tmp_path / "cache"), lambda: now[0])
    ev = event_rows(spark, [("e1", "a", "t", None, at(0)), ("e2", "b", "t", None, at(0))])
    seen = lambda i: [r.username for r in cache(ev, i).orderBy("event_id").collect()]
    assert seen(0) == ["A1", None]
    profile_rows(spark, [("a", "A2", "s", "d", at(9)), ("b", "B1", "s", "d", at(0))]
                 ).write.mode("append").parquet(table)
    now[0] += timedelta(minutes=9, seconds=59)
    assert seen(1) == ["A1", "B1"]      # the hit is kept, the miss was not
    assert seen(1) == ["A1", "B1"]      # a repeated batch gives the same
    now[0] += timedelta(seconds=1)
    assert seen(2) == ["A2", "B1"]      # the first entry has expired


def test_cache_grows_by_merged_segments(spark, tmp_path):
    """Rows written stay within a small multiple of the fetched ones, and buckets follow the entries."""
    users = [f"u{i}" for i in range(320)]
    stored = profile_rows(spark, [(u, u.upper(), "s", "d", at(0)) for u in users]).cache()
    now = [datetime(2024, 1, 1, tzinfo=timezone.utc)]
    cache = CachedLookup(lambda: stored, timedelta(minutes=60), str(tmp_path / "cache"), lambda: now[0], bucket_rows=40)
    for i in range(8):
        seen = users[40 * i:40 * i + 40] + users[:5]
        ev = event_rows(spark, [(f"{i}-{u}", u, "t", None, at(0)) for u in seen])
        for _ in range(1 + (i == 5)):  # one batch comes twice
            got = {r.user_id: r.username for r in cache(ev, i).collect()}
            assert got == {u: u.upper() for u in seen}
        now[0] += timedelta(minutes=1)
    segments = cache._after[7]
    assert sum(s.rows for s in segments) == 320 and max(s.buckets for s in segments) == 8
    assert cache.written <= 320 * 5 + 160
    folders = {p.name for p in next((tmp_path / "cache").iterdir()).iterdir() if p.is_dir()}
    assert folders == {s.path.rsplit("/", 1)[1] for i in (6, 7) for s in cache._after[i]}
    now[0] += timedelta(minutes=60)  # all have expired: dropped unread
    ev = event_rows(spark, [("x", "u1", "t", None, at(0)), ("y", "none", "t", None, at(0))])
    assert {r.user_id: r.username for r in cache(ev, 8).collect()} == {"u1": "U1", "none": None}
    assert [s.rows for s in cache._after[8]] == [1]


def test_write_each_applies_a_lookup(spark, sf_dir, topic_dir, tmp_path):
    stored = tables.to_profile_rows(src.profile_table(spark, sf_dir)).rows
    rows = ps.parse_events(replay(spark, topic_dir["user-events"])).rows
    out = str(tmp_path / "out")
    sinks.write_each(rows, ExternalLookup(lambda: stored), out, str(tmp_path / "cp"), trigger=NOW
                     ).awaitTermination()
    got = spark.read.parquet(out).where("event_id <> 'end'").drop("batch_id")
    want = lk.enrich_static(ps.parse_events(src.event_messages(spark, sf_dir)).rows, stored)
    assert tuples(got.select(want.columns)) == tuples(want)


def hybrid(spark, tmp_path, events, updates, stored, files, parts=3, name="h"):
    """The stream over messages in ``files`` files a side, one file per micro-batch."""
    dirs = {}
    for side, df in (("e", events), ("p", updates)):
        dirs[side] = str(tmp_path / f"{name}-{side}")
        store(df, dirs[side], files)
    close(spark, dirs["e"], event_id="end", user_id="end", event_type="end")
    close(spark, dirs["p"], user_id="end", username="end", user_segment="end", registration_date="d")
    rows = enrich_hybrid_stream(ps.parse_events(replay(spark, dirs["e"])).rows,
                                ps.parse_profiles(replay(spark, dirs["p"])).rows, stored, parts,
                                delay="60 days")
    return run(rows, tmp_path, name).where("event_id <> 'end'")


@pytest.mark.parametrize("parts,files", [(1, 1), (3, 5)])
def test_hybrid_state_equals_batch(spark, sf_dir, tmp_path, parts, files):
    stored = tables.to_profile_rows(src.profile_table(spark, sf_dir)).rows
    events, updates = src.event_messages(spark, sf_dir), src.profile_messages(spark, sf_dir)
    got = hybrid(spark, tmp_path, events, updates, stored, files, parts)
    want = lk.enrich_hybrid(ps.parse_events(events).rows, stored, ps.parse_profiles(updates).rows)
    assert tuples(got.select(want.columns)) == tuples(want)


@pytest.mark.parametrize("count,files", [(15_000, 1), (40_000, 5)])
def test_hybrid_state_of_a_hot_user(spark, tmp_path, count, files):
    """More rows than an Arrow chunk holds; updates lie between events and come in reverse order."""
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    time = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    shape = lambda df, value: topics.envelope(df.select(
        F.lit("u").alias("key"), F.to_json(F.struct(*value)).alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), (F.lit(count) - F.col("id")).alias("offset"), time.alias("timestamp")))
    events = shape(spark.range(count), [
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("u").alias("user_id"),
        F.lit("view").alias("event_type"), iso(time).alias("timestamp")])
    updates = shape(spark.range(0, count, count // 40).withColumn("id", F.col("id") + 7), [
        F.lit("u").alias("user_id"), F.concat(F.lit("n"), "id").alias("username"),
        F.lit("s").alias("user_segment"), F.lit("d").alias("registration_date"),
        iso(time).alias("timestamp")])
    got = hybrid(spark, tmp_path, events, updates, None, files)
    want = lk.enrich_hybrid(ps.parse_events(events).rows, profile_rows(spark, []),
                            ps.parse_profiles(updates).rows).select(got.columns)
    assert got.count() == count and got.exceptAll(want).isEmpty()


def test_cached_state_with_event_clock(spark, tmp_path):
    """The candidate is the same all the time; only its take-up times matter here."""
    path = str(tmp_path / "e")
    times = [at(0), at(5), at(10), at(300)]
    messages(spark, [event(i, time=t) for i, t in enumerate(times)] + [event(9, user="x")]
             ).coalesce(1).write.parquet(path)
    profiles = profile_rows(spark, [("u1", "n", "s", "d", at(0))])
    for clock in ("event", "processing"):
        rows = ps.parse_events(topics.replay_stream(spark, path)).rows
        got = run(enrich_cached_stream(rows, profiles, 10_000, clock), tmp_path, clock)
        assert tuples(got.select("event_id", "username")) == [
            ("e0", "n"), ("e1", "n"), ("e2", "n"), ("e3", "n"), ("e9", None)]
    with pytest.raises(ValueError):
        enrich_cached_stream(rows, profiles, 1, "wall")


def test_state_cleanup_runs_on_the_processing_clock(spark, tmp_path):
    path = str(tmp_path / "e")
    messages(spark, [event(1), event(2, user="x")]).write.parquet(path)
    profiles = profile_rows(spark, [("u1", "n", "s", "d", at(0))])
    rows = ps.parse_events(topics.replay_stream(spark, path)).rows
    out = enrich_cached_stream(rows, profiles, 60_000, cleanup=True)
    q = sinks.append(out, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"),
                     trigger={"processingTime": "1 second"})
    try:
        for _ in range(60):
            if any(p.numInputRows for p in q.recentProgress):
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert tuples(got.select("event_id", "username")) == [("e1", "n"), ("e2", None)]


def test_cached_state_keeps_the_old_profile_until_it_expires(spark, tmp_path):
    path = str(tmp_path / "e")

    def once(name):
        profiles = profile_rows(spark, [("u1", name, "s", "d", at(0))])
        rows = ps.parse_events(topics.replay_stream(spark, path)).rows
        return run(enrich_cached_stream(rows, profiles, 60_000, "event"), tmp_path, "c")

    messages(spark, [event(1, time=at(0))]).write.parquet(path)
    once("old")
    messages(spark, [event(2, time=at(59.9)), event(3, time=at(60))], start=5
             ).coalesce(1).write.mode("append").parquet(path)
    got = once("new")
    assert tuples(got.select("event_id", "username")) == [("e1", "old"), ("e2", "old"),
                                                          ("e3", "new")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_replay_formats(spark, tmp_path, fmt):
    df = messages(spark, [event(0), None])
    df.write.format(fmt).save(str(tmp_path / "t"))
    got = topics.replay_batch(spark, str(tmp_path / "t"), fmt)
    assert tuples(got) == tuples(df) and got.columns == S.ENVELOPE.names
    with pytest.raises(ValueError):
        topics.replay_stream(spark, "x", "xml")


def test_broker_options():
    assert [topics.starting_offsets(x) for x in ("Earliest", "EARLIEST", "latest", "x", None)] == [
        "earliest", "earliest", "latest", "latest", "latest"]
    opts = topics._options("h:9092", ["a", "b"], "earliest", "g", {"maxOffsetsPerTrigger": "10"})
    assert opts == {"kafka.bootstrap.servers": "h:9092", "subscribe": "a,b",
                    "startingOffsets": "earliest", "groupIdPrefix": "g",
                    "maxOffsetsPerTrigger": "10"}


def test_slices_of_a_replay_are_dealt_over_all_cores(spark, sf_dir):
    r = replays._Replay(spark, sf_dir, "dealt")
    r._store("user-events")
    rows = spark.read.parquet(r.path("user-events")).where(F.col("timestamp") <= F.lit(r.last))
    slices = F.floor(F.datediff("timestamp", F.lit(r.first)) / replays.SLICE)
    files = rows.select(slices.alias("slice"), F.input_file_name().alias("file")).distinct()
    assert all(n >= max(4, spark.sparkContext.defaultParallelism) for _, n in files.groupBy("slice").count().collect())
