"""Joins with many pairs per row: what is done once per row is not repeated for each pair."""

import pytest
from pyspark.sql import functions as F

from helpers import at, event, messages, tuples
from rillwork.operators import blocks, join as jn, lookup as lk, parse as ps
from rillwork.plans import inputs as src
from rillwork.plans.catalog import BATCH
from rillwork.plans.jobs import MultiTopicJob, wait
from rillwork.sources import topics
from rillwork.streaming import sinks
from rillwork.streaming.lookups import RefreshingLookup


@pytest.mark.parametrize("name", ["join_events_products_1d", "join_events_products_split"])
def test_times_are_converted_before_the_join(spark, sf_dir, name):
    plan = BATCH[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line and "_kproduct_id" in line)
    casts = [i for i, line in enumerate(plan) if "as timestamp_ntz" in line]
    assert casts and min(casts) > join


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_blocks_hold_all_rows(spark, held):
    rows = [(k, i, f"v{i}", at(i)) for i, k in enumerate(["a"] * 300 + [None] * 5 + ["b"])]
    df = spark.createDataFrame(rows, "k string, n int, v string, t timestamp").withColumn("w", F.window("t", "1 hour"))
    got = blocks.pack(df.repartition(3), ["k", "w"], ["k", "n", "v", "t"], "rows", 128, held)
    sizes = [r[0] for r in got.select(F.size("rows")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 128
    assert len(sizes) == 5 if held > 1 else len(sizes) >= 5
    assert got.where("exists(rows, r -> not r.k <=> k or r.t < w.start)").count() == 0
    assert tuples(got.select(F.inline("rows"))) == tuples(df.select("k", "n", "v", "t"))
    assert blocks.pack(df.limit(0), ["k", "w"], ["n"], "rows").count() == 0


@pytest.mark.parametrize("marked", [False, True])
def test_a_stream_joins_blocks_of_rows(spark, tmp_path, marked):
    ev = [event(i, product=["p1", None, "p2"][i % 3]) for i in range(90)]
    up = [{"product_id": "p1", "product_name": f"n{i}", "price": i, "category": "c", "timestamp": at(i).isoformat()}
          for i in range(40)]
    for name, rows in (("e", ev), ("p", up)):
        messages(spark, rows).coalesce(1).write.parquet(str(tmp_path / name))
        end = {"event_id": "end", "user_id": "end", "event_type": "end", "product_id": "end", "product_name": "end",
               "price": 0, "category": "end", "timestamp": at(10 ** 6).isoformat()}
        messages(spark, [end], start=1000).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    read = lambda name: topics.replay_stream(spark, str(tmp_path / name), maxFilesPerTrigger="1")
    events, products = ps.parse_events(read("e")).rows, ps.parse_products(read("p")).rows
    if marked:
        events = events.withWatermark("event_time", "1 minute")
    joined = jn.left_join_in_window(events, products, "1 hour", spread=2, marked=marked)
    q = sinks.append(joined, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), trigger=sinks.AVAILABLE_NOW)
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).where("event_id <> 'end'")
    parsed = ps.parse_events(messages(spark, ev)).rows, ps.parse_products(messages(spark, up)).rows
    assert tuples(got) == tuples(jn.left_join_in_window(*parsed, "1 hour", hot_rows=None))
    kept = sum(s.numRowsUpdated for p in q.recentProgress for s in p.stateOperators)
    assert 0 < kept < (60 if marked else 30)


def test_profiles_that_stay_meet_events_not_pairs(spark, sf_dir, tmp_path):
    class Fixed(RefreshingLookup):
        def __call__(self, batch, batch_id):
            raise AssertionError("called with the pairs of a micro-batch")

    made = {"user-events": src.event_messages, "product-updates": src.product_messages,
            "user-profiles": src.profile_messages}
    for name, fn in made.items():
        fn(spark, sf_dir).coalesce(1).write.parquet(str(tmp_path / name))
    parsed = [ps.parse_events(src.event_messages(spark, sf_dir)).rows,
              ps.parse_products(src.product_messages(spark, sf_dir)).rows,
              ps.parse_profiles(src.profile_messages(spark, sf_dir)).rows]
    wait(MultiTopicJob(
        user_events_topic="user-events", product_updates_topic="product-updates", user_profiles_topic="user-profiles",
        enriched_events_table=str(tmp_path / "out"), width="1 hour", checkpoint=str(tmp_path / "cp"),
        trigger=sinks.AVAILABLE_NOW, lookup=Fixed(lambda: parsed[2], None),
        open_topic=lambda s, t: topics.replay_stream(s, str(tmp_path / t))).start(spark))
    want = jn.enriched_records(lk.enrich_static(jn.join_in_window(*parsed[:2], "1 hour"), parsed[2]))
    matched = spark.read.parquet(str(tmp_path / "out")).select(want.columns).where("product_id is not null")
    assert tuples(matched.drop("processing_time")) == tuples(
        want.where("product_id is not null").drop("processing_time")) != []
