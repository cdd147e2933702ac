"""Bucketed tables, maintained keep-latest and commits of several tables."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, event, event_rows, messages, profile_rows, tuples
from rillwork import schemas as S
from rillwork.operators import aggregate as agg, lookup as lk, parse as ps
from rillwork.plans.jobs import BranchedJob, wait
from rillwork.sources import buckets, files, topics
from rillwork.sources.buckets import BucketedTable
from rillwork.streaming import commits, sinks
from rillwork.streaming.lookups import BucketedLookup, ExternalLookup, keep_latest

NOW = sinks.AVAILABLE_NOW


def profiles(spark, n, version=0):
    return profile_rows(spark, [(f"u{i}", f"n{i}v{version}", "s", "d", at(i + version)) for i in range(n)])


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable.create(str(tmp_path / "t"), agg.latest_profiles(profiles(spark, 500)), buckets=16)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_one_key_reads_one_bucket(spark, table):
    df = lk.point_lookup(table.of_key("u77"), "u77")
    assert [r.username for r in df.collect()] == ["n77v0"]
    assert len(table.rows().inputFiles()) == 16 and len(df.inputFiles()) == 1
    assert "EqualTo(user_id,u77)" in plan(df)
    assert table.of_key("nobody").collect() == []


@pytest.mark.parametrize("count", [0, 2, 400, 500])
def test_keys_read_their_buckets_only(spark, table, monkeypatch, count):
    keys = spark.createDataFrame([(f"u{i}",) for i in range(count)] * 2 + [(None,), ("nobody",)], "k string")
    want = [(f"u{i}",) for i in range(count)]
    df = table.of_keys(keys)
    assert tuples(df.select("user_id")) == sorted(want)
    assert len(df.inputFiles()) <= min(16, count + 1)
    assert "PushedFilters: [In(user_id" in plan(df) or count != 2
    monkeypatch.setattr(buckets, "LISTED", 3)
    assert tuples(table.of_keys(keys).select("user_id")) == sorted(want)


def test_bucketed_lookup_equals_external_lookup(spark, table):
    ev = event_rows(spark, [(f"e{i}", u, "t", None, at(0)) for i, u in enumerate(["u1", "u2", "u1", "x"])])
    default = {"username": "none"}
    want = ExternalLookup(table.rows, default)(ev, 0)
    got = BucketedLookup(table.path, default)(ev, 0)
    assert tuples(got.select(want.columns)) == tuples(want)
    assert "none" in [r.username for r in got.collect()]


def test_a_merge_writes_touched_buckets_only(spark, table):
    before = dict(table.folders)
    changed = profile_rows(spark, [("u5", "new", "s", "d", at(9999)), ("u6", "old", "s", "d", at(0)),
                                   ("fresh", "f", "s", "d", at(1))])
    table.merge_latest(changed, agg.PROFILE_ORDER, 1)
    again = BucketedTable(spark, table.path)
    names = {r.user_id: r.username for r in again.rows().collect()}
    assert (names["u5"], names["u6"], names["fresh"], len(names)) == ("new", "n6v0", "f", 501)
    moved = {b for b, v in again.folders.items() if before.get(b) != v}
    assert 1 <= len(moved) <= 3
    again.merge_latest(profiles(spark, 500, 5), agg.PROFILE_ORDER, 1)  # a repeated version changes nothing
    assert again.rows().where("username like '%v5'").isEmpty()
    for version in (2, 3, 4):
        again.merge_latest(profiles(spark, 500, version), agg.PROFILE_ORDER, version)
    assert again.rows().where("username like '%v4'").count() >= 498
    assert len(files.names(spark, f"{table.path}/manifest")) == 2


def test_a_half_written_version_is_replaced(spark, table, monkeypatch):
    publish = files.publish
    monkeypatch.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge_latest(profiles(spark, 9, 1), agg.PROFILE_ORDER, 1)
    monkeypatch.setattr(files, "publish", publish)
    opened = BucketedTable(spark, table.path)
    assert opened.version == 0 and opened.rows().where("username like '%v1'").isEmpty()
    opened.merge_latest(profiles(spark, 9, 2), agg.PROFILE_ORDER, 1)
    assert BucketedTable(spark, table.path).rows().where("username like '%v2'").count() == 9


@pytest.mark.parametrize("pieces", [1, 4])
def test_a_maintained_table_equals_keep_latest(spark, tmp_path, pieces):
    rng = random.Random(pieces)
    rows = [(f"u{rng.randrange(40)}", f"n{i}", "s", "d", at(rng.randrange(50))) for i in range(300)]
    table = BucketedTable.create(str(tmp_path / "t"), agg.latest_profiles(profiles(spark, 20)), buckets=8)
    source = str(tmp_path / "in")
    run = lambda: keep_latest(
        spark.readStream.schema(S.PROFILE_ROW).option("maxFilesPerTrigger", 1).parquet(source), table,
        str(tmp_path / "cp"), NOW).awaitTermination()
    for i in range(pieces):
        profile_rows(spark, rows[i::pieces]).coalesce(1).write.mode("append").parquet(source)
        if i % 2:
            run()  # and started again
    run()
    want = agg.latest_profiles(profiles(spark, 20).unionByName(profile_rows(spark, rows)))
    assert tuples(BucketedTable(spark, table.path).rows().select(want.columns)) == tuples(want)


class Lost(Exception):
    pass


def committed_job(spark, tmp_path):
    return BranchedJob(topic="t", output_table="flat", generic_output_table="generic", quarantine="rejects",
                       commit_root=str(tmp_path / "tables"), checkpoint=str(tmp_path / "cp"), trigger=NOW,
                       open_topic=lambda s, t: topics.replay_stream(s, str(tmp_path / "in"), maxFilesPerTrigger="1"))


@pytest.mark.parametrize("lost_at", range(1, 9))
def test_a_lost_driver_leaves_each_row_once_in_all_tables(spark, tmp_path, monkeypatch, lost_at):
    """Two micro-batches; the driver is lost before one of the writes: three tables and the log, twice."""
    for i in range(2):
        messages(spark, [event(10 * i + k) for k in range(5)] + ["no json"], start=10 * i).coalesce(
            1).write.mode("append").parquet(str(tmp_path / "in"))
    calls = [0]

    def counted(fn):
        def call(*args, **kw):
            calls[0] += 1
            if calls[0] == lost_at:
                raise Lost()
            return fn(*args, **kw)
        return call

    with monkeypatch.context() as m:
        m.setattr(sinks, "append", counted(sinks.append))
        m.setattr(files, "publish", counted(files.publish))
        with pytest.raises(Exception):
            wait(committed_job(spark, tmp_path).start(spark))
    root = str(tmp_path / "tables")
    if commits.CommitLog(spark, root).entries:
        assert {commits.committed(spark, root, t).count() for t in ("flat", "generic")} == {5}
    wait(committed_job(spark, tmp_path).start(spark))
    flat = sorted(r.event_id for r in commits.committed(spark, root, "flat").collect())
    assert flat == sorted(f"e{10 * i + k}" for i in range(2) for k in range(5))
    assert commits.committed(spark, root, "generic").count() == 10
    assert "event_time_day" in commits.committed(spark, root, "generic").columns
    assert commits.committed(spark, root, "rejects").count() == 2


def test_the_log_is_compacted(spark, tmp_path):
    root, log = str(tmp_path), commits.CommitLog(spark, str(tmp_path))
    schema = spark.range(1).schema
    for i in range(25):
        spark.range(i, i + 1).write.parquet(f"{root}/t/batch={i}")
        log.publish(i, {"t": schema}, ["t"])
    assert len(files.names(spark, f"{root}/_log")) <= commits.COMPACT
    assert commits.CommitLog(spark, root).last == 24
    assert sorted(r.id for r in commits.committed(spark, root, "t").collect()) == list(range(25))
    with pytest.raises(ValueError):
        commits.committed(spark, root, "other")


def test_markers_do_not_pile_up(spark, tmp_path):
    for batch_id in range(5):
        sinks.write_batch(spark.range(1), batch_id, str(tmp_path / "t"), str(tmp_path / "m"))
    assert files.names(spark, str(tmp_path / "m")) == ["4"] and sinks.last_written(spark, str(tmp_path / "m")) == 4
