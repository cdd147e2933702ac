"""Lookups on the event clock, renewed dimensions, counters, late rows, user functions and pruned top-k."""

import json
import random
from datetime import timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import T0, at, event, event_rows, messages, profile_rows, tuples
from rillwork import schemas as S
from rillwork.functions.payload import Isolated
from rillwork.operators import inspect as look, parse as ps
from rillwork.sources import files
from rillwork.streaming import cells, commits, counters, sinks
from rillwork.streaming.versions import VersionedTable, clock, refresh_on

NOW = sinks.AVAILABLE_NOW
FAR = timedelta(days=900)


def made(seed, events=300, users=6):
    rng = random.Random(seed)
    span = lambda: rng.randrange(0, 4000)
    ev = [(f"e{i}", f"u{rng.randrange(users + 1)}", "t", None, at(span())) for i in range(events)]
    up = [(f"u{rng.randrange(users)}", f"n{rng.randrange(9)}", f"s{i}", rng.choice(["d", "d2"]), at(span()))
          for i in range(60)]
    return ev, up


def streamed(spark, tmp_path, ev, up, pieces, enrich):
    """The rows in ``pieces`` micro-batches in order of time, then one that closes everything."""
    end = T0 + FAR
    for rows, schema, time, last in ((ev, S.EVENT_ROW, 4, ("end", "end", "t", None, end)),
                                     (up, S.PROFILE_ROW, 4, ("end", "n", "s", "d", end))):
        path = str(tmp_path / ("e" if schema is S.EVENT_ROW else "p"))
        ordered = sorted(rows, key=lambda r: r[time])
        size = -(-len(ordered) // pieces)
        for part in [ordered[i:i + size] for i in range(0, len(ordered), size)] + [[last]]:
            random.Random(1).shuffle(part)
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / name))
    df = enrich(read("e", S.EVENT_ROW), read("p", S.PROFILE_ROW))
    q = sinks.append(df, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), trigger=NOW)
    assert q.awaitTermination(180)
    return spark.read.parquet(str(tmp_path / "out")).where("user_id <> 'end'")


def seen_by(e, up):
    return sorted((u[4], u[1:4]) for u in up if u[0] == e[1] and u[4] <= e[4])


def brute_cache(ev, up, ttl):
    out, entry = [], {}
    for e in sorted(ev, key=lambda e: (e[4], e[0])):
        held = entry.get(e[1])
        if held and e[4] >= held[0] + ttl:
            out.append((None, e[1], held[0] + ttl, *held[1], "expired"))
            held = entry.pop(e[1]) and None
        did, found = "hit", seen_by(e, up)
        if not held:
            did = "fetch" if found else "miss"
            if found:
                held = entry[e[1]] = (e[4], found[-1][1])
        out.append((e[0], e[1], e[4], *(held[1] if held else (None,) * 3), did))
    out += [(None, u, t + ttl, *p, "expired") for u, (t, p) in entry.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("pieces", [1, 5])
def test_expiring_cache_equals_a_walk(spark, tmp_path, pieces):
    ev, up = made(pieces)
    got = streamed(spark, tmp_path, ev, up, pieces, lambda e, u: cells.enrich_expiring_stream(
        e, u, 300_000, delay="1 hour", cells=3))
    rows = [(r.event_id, r.user_id, r.event_time, r.username, r.user_segment, r.registration_date, r.cache)
            for r in got.collect()]
    want = brute_cache(ev, up, timedelta(minutes=5))
    assert sorted(rows, key=repr) == want
    assert {r[-1] for r in want} == {"hit", "fetch", "miss", "expired"}


@pytest.mark.parametrize("parts,pieces", [(1, 1), (3, 4)])
def test_live_maxima_equal_brute_force(spark, tmp_path, parts, pieces):
    ev, up = made(7)
    stored = [("u0", "zz", "s", None, at(0)), ("u0", "a", None, "d9", at(9)), ("u6", "only", "s", "d", at(9999))]
    got = streamed(spark, tmp_path, ev, up, pieces, lambda e, u: cells.enrich_sql_stream(
        e, u, profile_rows_nullable(spark, stored), parts=parts, delay="1 hour", cells=2))
    top = lambda xs: max((x for x in xs if x is not None), default=None)
    want = []
    for e in ev:
        known = [p for _, p in seen_by(e, up)] + [s[1:4] for s in stored if s[0] == e[1]]
        want.append((e[0], *[top(c) for c in zip(*known)]) if known else (e[0], None, None, None))
    assert tuples(got.select("event_id", "username", "user_segment", "registration_date")) == sorted(want, key=repr)


def profile_rows_nullable(spark, rows):
    return spark.createDataFrame(rows, "user_id string, username string, user_segment string, "
                                       "registration_date string, timestamp timestamp")


def test_dedup_is_checked(spark):
    with pytest.raises(ValueError):
        cells.enrich_sql_stream(None, None, dedup="some")


def test_versions_that_can_be_seen_stay():
    rows = pd.DataFrame({"micros": [5, 1, 3, 2, 9], "user_id": list("aabaa"), "username": list("vwxyz"),
                         "user_segment": None, "registration_date": None})
    rule = cells.Latest()
    kept = rule.stale(rule.versions(rows), 5)
    assert sorted(kept["username"]) == ["v", "x", "z"]
    events = pd.DataFrame({"micros": [1, 2, 4, 5, 8, 9], "user_id": ["a", "a", None, "a", "b", "c"]})
    found = cells.version_of(events, rule.versions(rows))
    names = rule.versions(rows)["username"].to_numpy()
    assert [names[i] if i >= 0 else None for i in found] == ["w", "y", None, "v", "x", None]
    assert cells.version_of(events, rows.head(0)).tolist() == [-1] * 6


# Renewed dimensions ---------------------------------------------------------------------------------------

DIM = "user_id string, username string"


def test_a_refresh_writes_differences(spark, tmp_path):
    dim = lambda *rows: spark.createDataFrame(list(rows), DIM)
    table = VersionedTable(spark, str(tmp_path / "v"), dim(("x", "x")).schema)
    assert table.as_of().collect() == []
    assert table.refresh(dim(("a", "A"), ("b", "B"), ("c", None)), at(0)) == 3
    assert table.refresh(dim(("a", "A"), ("b", "B2"), ("d", "D")), at(60)) == 3  # changed, gone, new
    assert table.refresh(dim(("a", "A"), ("b", "B2"), ("d", "D")), at(120)) == 0
    assert table.refresh(dim(("a", "late")), at(100)) == 0
    assert table.refresh(dim(("c", "C")), at(180)) == 4
    now = lambda t: tuples(VersionedTable(spark, table.path, table.schema).as_of(t).select("user_id", "username"))
    assert now(at(-1)) == [] and now(at(59)) == [("a", "A"), ("b", "B"), ("c", None)]
    assert now(at(179)) == [("a", "A"), ("b", "B2"), ("d", "D")] and now(None) == [("c", "C")]
    ev = event_rows(spark, [(f"e{t}{u}", u, "t", None, at(t)) for t in (-1, 0, 60, 200) for u in "abcd"])
    got = {r.event_id: r.username for r in table.join(ev, ["username"]).collect()}
    assert got["e-1a"] is None and got["e0b"] == "B" and got["e60b"] == "B2" and got["e60c"] is None
    assert got["e200a"] is None and got["e200c"] == "C" and len(got) == 16


def test_a_half_written_refresh_is_done_again(spark, tmp_path, monkeypatch):
    dim = spark.createDataFrame([("a", "A")], DIM)
    table = VersionedTable(spark, str(tmp_path / "v"), dim.schema)
    with monkeypatch.context() as m:
        m.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.refresh(dim, at(0))
    assert table.versions() == [] and table.refresh(dim, at(0)) == 1 and table.as_of().count() == 1


def test_ticks_follow_the_clock(spark, tmp_path):
    dim = spark.createDataFrame([("a", "A")], DIM)
    table, seen = VersionedTable(spark, str(tmp_path / "v"), dim.schema), []

    def load(now):
        seen.append(now)
        return dim.withColumn("username", F.lit(str(len(seen))))

    ticks = clock(spark, 600, T0)
    for _ in range(3):
        refresh_on(ticks, table, load, str(tmp_path / "cp"), NOW).awaitTermination()
    first = T0.replace(tzinfo=timezone.utc)
    assert seen == [first + i * timedelta(minutes=10) for i in range(3)]
    assert [v["changed"] for v in table.versions()] == [True] * 3 and clock(spark).isStreaming


# Counters, late rows, user functions, newest days ---------------------------------------------------------

def test_counters_of_a_running_query(spark, tmp_path):
    table = counters.CounterTable(spark, str(tmp_path / "c"))
    spark.streams.addListener(table)
    try:
        for i in range(3):
            spark.createDataFrame([(k, None if k % 2 else "n") for k in range(4 + i)], "id int, username string"
                                  ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        df = spark.readStream.schema("id int, username string").option("maxFilesPerTrigger", 1).parquet(
            str(tmp_path / "in"))
        q = sinks.append(counters.counted(df), str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), trigger=NOW)
        q.awaitTermination()
        for _ in range(300):
            if str(q.runId) in table.ended:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(table)
    got = table.rows().orderBy("batch_id").select("lookups", "hits", "misses", "late").collect()
    assert [tuple(r) for r in got] == [(4, 2, 2, 0), (5, 3, 2, 0), (6, 3, 3, 0)]


def test_late_rows_are_kept_apart(spark, tmp_path):
    batches = [[(1, at(100)), (2, at(0))], [(3, at(40)), (4, at(39)), (5, None)], [], [(6, at(500))],
               [(7, at(440)), (8, at(441))]]
    for rows in batches:
        spark.createDataFrame(rows, "id int, t timestamp").coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
        df = spark.readStream.schema("id int, t timestamp").parquet(str(tmp_path / "in"))
        commits.write_split_late(df, "t", timedelta(seconds=60), str(tmp_path / "out"), str(tmp_path / "cp"),
                                 NOW).awaitTermination()  # each time a new run
    on_time, late = (commits.committed(spark, str(tmp_path / "out"), t) for t in ("on_time", "late"))
    assert sorted(r.id for r in on_time.collect()) == [1, 2, 6, 8]
    assert sorted((r.id, r.late_by) for r in late.collect()) == [(3, 0.0), (4, 1.0), (5, None), (7, 0.0)]


def test_a_failing_function_rejects_its_message_only(spark):
    def fn(text):
        n = json.loads(text)["n"]
        return {0: lambda: 1 / 0, 1: lambda: 7, 2: lambda: "no json"}.get(
            n, lambda: json.dumps({"event_time": "2024-01-01T00:00:00", "payload": str(n)}))()

    df = messages(spark, [{"n": i} for i in range(5)] + ["broken", None])
    done = ps.parse_payload(df, Isolated(fn))
    assert sorted(r.payload for r in done.rows.collect()) == ["3", "4"]
    errors = {r.offset: r.error for r in done.rejects.collect()}
    assert errors[0].startswith("function failed: ZeroDivisionError") and "int, not text" in errors[1]
    assert errors[2] == "not a JSON object" and errors[5].startswith("function failed: JSONDecodeError")
    assert errors[6] == "null value" and len(errors) == 5
    assert [r.value for r in done.rejects.where("offset = 5").collect()] == ["broken"]


def test_strict_fields_are_strings(spark):
    df = messages(spark, [event(1), {**event(2), "user_id": 7}, {**event(3), "event_type": True},
                          {**event(4), "product_id": None}, {**event(5), "event_id": {"a": 1}}])
    loose, strict = ps.parse_events(df), ps.parse_events(df, strict=True)
    assert loose.rows.count() == 4 and sorted(r.event_id for r in strict.rows.collect()) == ["e1", "e4"]
    assert {r.offset: r.error for r in strict.rejects.collect()} == {
        1: "not a string: user_id", 2: "not a string: event_type", 4: "object or array in a text field"}


def test_newest_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, T0 + timedelta(hours=6 * (i // 2))) for i in range(80)] + [(99, None)]
    sinks.append(spark.createDataFrame(rows, "id int, t timestamp"), path, partition_by="t")
    for n in (1, 7, 8, 9, 30, 80, 81, 200):
        got = look.newest_by_day(spark, path, "t_day", "t", n, ("id",)).select("id").collect()
        want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, -r[0]), reverse=True)[:n]
        assert [r.id for r in got] == [r[0] for r in want]
    df = look.newest_by_day(spark, path, "t_day", "t", 8, ("id",))
    assert len({f.split("t_day=")[1][:10] for f in df.inputFiles()}) == 1
    assert len({f.split("t_day=")[1][:10] for f in spark.read.parquet(path).inputFiles()}) == 11
