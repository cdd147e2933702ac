"""Small hand-written inputs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rillwork import schemas as S

T0 = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def messages(spark, values, topic="user-events", start=0):
    """Envelope rows from JSON-able values (dict), raw text, or None."""
    rows = [(None, v if v is None or isinstance(v, str) else json.dumps(v), topic, 0, start + i,
             at(start + i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, S.ENVELOPE)


def event(i, user="u1", kind="view", product="p1", time=None, **more):
    out = {"event_id": f"e{i}", "user_id": user, "event_type": kind, "product_id": product,
           "timestamp": (time or at(i)).isoformat(), **more}
    return {k: v for k, v in out.items() if v is not ...}


def event_rows(spark, rows):
    """(event_id, user_id, event_type, product_id, event_time)"""
    return spark.createDataFrame(rows, S.EVENT_ROW)


def product_rows(spark, rows):
    return spark.createDataFrame(rows, S.PRODUCT_ROW)


def profile_rows(spark, rows):
    return spark.createDataFrame(rows, S.PROFILE_ROW)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def record_of(value):
    """A payload function: the record of an event message."""
    time = F.get_json_object(value, "$.timestamp")
    return F.to_json(F.struct(time.alias("event_time"), value.alias("payload")))
