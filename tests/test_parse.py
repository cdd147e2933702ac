import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import at, event, messages, tuples
from rillwork import schemas as S
from rillwork.functions import parse_time
from rillwork.operators import parse as ps
from rillwork.sources import tables


def test_missing_and_null_product_id(spark):
    df = messages(spark, [event(0), event(1, product=...), event(2, product=None)])
    flat = {r.event_id: r.product_id for r in ps.flatten_events(df).collect()}
    rows = {r.event_id: r.product_id for r in ps.parse_events(df).rows.collect()}
    assert flat == {"e0": "p1", "e1": "", "e2": ""}
    assert rows == {"e0": "p1", "e1": None, "e2": None}


def test_rejects_and_coercions(spark):
    ok = event(0)
    no_user = {k: v for k, v in ok.items() if k != "user_id"}
    df = messages(spark, [ok, "no json", "[1]", None, no_user, event(5, user=7),
                          event(6, time=None) | {"timestamp": "garbage"}, "", '"text"', "{}"])
    parsed = ps.parse_events(df)
    assert [r.user_id for r in parsed.rows.orderBy("event_id").collect()] == ["u1", "7"]
    errors = {r.offset: r.error for r in parsed.rejects.collect()}
    assert errors == {
        1: "not a JSON object", 2: "not a JSON object", 3: "null value",
        4: "missing or invalid: user_id", 6: "missing or invalid: event_time",
        7: "not a JSON object", 8: "not a JSON object",
        9: "missing or invalid: event_id,user_id,event_type,event_time"}
    assert parsed.rows.schema.names == S.EVENT_ROW.names
    assert set(df.columns) < set(parsed.rejects.columns)


def test_fail_mode_raises(spark):
    df = messages(spark, [event(0), "no json"])
    with pytest.raises(Exception, match="bad message, not a JSON object"):
        ps.parse_events(df, mode="fail").rows.collect()
    assert ps.parse_events(messages(spark, [event(0)]), mode="fail").rows.count() == 1
    with pytest.raises(ValueError):
        ps.parse_events(df, mode="other")


def test_quoted_price(spark):
    base = {"product_id": "p", "product_name": "n", "category": "c", "timestamp": at(0).isoformat()}
    df = messages(spark, [base | {"price": "12.5"}, base | {"price": 12.5}, base | {"price": "x"}])
    parsed = ps.parse_products(df)
    assert [r.price for r in parsed.rows.collect()] == [12.5, 12.5]
    assert [r.error for r in parsed.rejects.collect()] == ["missing or invalid: price"]


TIMES = {
    "2025-08-29 01:22:02.514805 UTC": dt.datetime(2025, 8, 29, 1, 22, 2, 514805),
    "2025-08-29 01:22:02 UTC": dt.datetime(2025, 8, 29, 1, 22, 2),
    "2025-08-29T01:22:02": dt.datetime(2025, 8, 29, 1, 22, 2),
    "2025-08-29T01:22:02.5Z": dt.datetime(2025, 8, 29, 1, 22, 2, 500000),
    "2025-08-29T01:22:02+02:00": dt.datetime(2025, 8, 28, 23, 22, 2),
    "garbage": None,
    "12:30": None,
    None: None,
}


def test_timestamp_forms(spark):
    df = spark.createDataFrame([(k,) for k in TIMES], "t string")
    got = df.select("t", parse_time(F.col("t")).cast("timestamp_ntz").alias("p"))
    assert {r.t: r.p for r in got.collect()} == TIMES


def test_stored_profiles_bad_time(spark):
    table = spark.createDataFrame(
        [("u", "n", "s", "2024-01-01", "2025-08-29 01:22:02 UTC"), ("v", "n", "s", "d", "bad")],
        "user_id string, username string, user_segment string, registration_date string, "
        "timestamp string")
    parsed = tables.to_profile_rows(table)
    assert [r.user_id for r in parsed.rows.collect()] == ["u"]
    assert [(r.user_id, r.error) for r in parsed.rejects.collect()] == [
        ("v", "missing or invalid: timestamp")]
    now = tables.to_profile_rows(table, on_bad_ts="now").rows.where("user_id = 'v'").collect()
    assert now[0].timestamp.year > 2024
    with pytest.raises(ValueError):
        tables.to_profile_rows(table, on_bad_ts="x")


def test_generic_keeps_text_and_variant(spark):
    text = '{ "timestamp" : "2024-01-01T00:00:00",   "x":1.50 }'
    row = ps.generic_events(messages(spark, [text])).collect()[0]
    assert row.payload == text and row.processing_time is not None
    variant = ps.generic_events(messages(spark, [text]), as_variant=True)
    assert variant.schema["payload"].dataType.simpleString() == "variant"
    assert variant.select(F.variant_get("payload", "$.x", "double")).collect()[0][0] == 1.5


def test_payload_hook_takes_an_arrow_udf(spark):
    @F.pandas_udf("string")
    def rename(s):
        return s.str.replace('"created"', '"event_time"')

    text = '{"created":"2024-01-01T00:00:00","payload":"x"}'
    row = ps.apply_payload_fn(messages(spark, [text]), rename).collect()[0]
    assert row.payload == "x" and row.event_time is not None
    parsed = ps.parse_payload(messages(spark, [text, "no json", '{"payload":"x"}']), rename)
    assert parsed.rows.count() == 1
    assert sorted((r.value, r.error) for r in parsed.rejects.collect()) == [
        ("no json", "not a JSON object"), ('{"payload":"x"}', "missing or invalid: event_time")]


def test_text_fields_take_scalars_only(spark):
    good = [event(1) | {"event_id": 7}, event(2) | {"event_type": True}, event(3) | {"user_id": "[x]"}]
    bad = [event(4) | {"event_id": {"a": 1}}, event(5) | {"user_id": ["x"]}]
    parsed = ps.parse_events(messages(spark, good + bad))
    assert sorted(tuples(parsed.rows.select("event_id", "user_id", "event_type"))) == [
        ("7", "u1", "view"), ("e2", "u1", "true"), ("e3", "[x]", "view")]
    assert [r.error for r in parsed.rejects.collect()] == ["object or array in a text field"] * 2


def test_profile_record_types(spark):
    value = {"user_id": "u", "username": "n", "user_segment": "new",
             "registration_date": "2024-02-30", "timestamp": at(0).isoformat()}
    parsed = ps.parse_profile_records(messages(spark, [value, value | {
        "registration_date": "2024-02-28"}]))
    assert [r.registration_date for r in parsed.rows.collect()] == [dt.date(2024, 2, 28)]
    assert [r.error for r in parsed.rejects.collect()] == ["missing or invalid: registration_date"]


def test_one_json_parse_per_message(spark):
    df = messages(spark, [event(0)])
    plan = ps.parse_events(df).rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple(") == 1 and "from_json" not in plan


def test_conform_contract(spark):
    df = spark.createDataFrame([("e", None, "t", None, at(0), at(0))],
                               "event_id string, user_id string, event_type string, "
                               "product_id string, timestamp timestamp, processing_time timestamp")
    with pytest.raises(Exception, match="NULL in required column user_id"):
        S.conform(df, S.USER_EVENTS).collect()
    assert S.conform(df, S.USER_EVENTS, on_null="keep").columns == S.USER_EVENTS.names
    assert df.select(S.violations(df, S.USER_EVENTS)).collect()[0][0] == "user_id"


def test_messages_round_trip(spark):
    rows = ps.parse_events(messages(spark, [event(0), event(1, product=...)])).rows
    sent = ps.to_messages(rows.withColumnRenamed("event_time", "timestamp"), "user_id")
    assert {r.key for r in sent.collect()} == {"u1"}
    assert tuples(ps.parse_events(sent).rows) == tuples(rows)
