"""Time parsing and windows. All of it assumes a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a timestamp must start with its year. Spark alone would read "12:30" as today.
LEADING_YEAR = r"^\s*\d{4}"


def parse_time(text: Column) -> Column:
    """ISO-8601, or ``yyyy-MM-dd HH:mm:ss[.SSSSSS] UTC``; anything else is NULL."""
    return F.when(text.rlike(LEADING_YEAR), F.try_to_timestamp(text))


def parse_date(text: Column) -> Column:
    return text.try_cast("date")


def millis_to_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def window_of(time: Column, width: str) -> Column:
    """Tumbling window struct (``start``, ``end``) of an event time."""
    return F.window(time, width)


def day_of(time: Column) -> Column:
    return F.to_date(time)
