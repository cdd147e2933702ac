"""Message text to typed rows.

Every parser reads its fields as text with one ``json_tuple``, then casts. A generator, unlike
``from_json``, is never copied into the filter on required fields, so each message is parsed once.
Rows that lack a required field go to the rejects side; nothing raises unless ``mode='fail'``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillwork import schemas as S
from rillwork.functions import parse_date, parse_time
from rillwork.functions.payload import Isolated

ERROR = "error"
PROFILE_FIELDS = ["user_id", "username", "user_segment", "registration_date"]


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _parse(df: DataFrame, fields: list[str], cols: dict[str, Column], schema: T.StructType,
           mode: str, strict: bool = False) -> Parsed:
    """Read ``fields`` of the message as text, cast to ``cols``, split on the null contract. ``strict``: a
    text field must hold a JSON string; numbers and booleans are rejected.

    Both sides are filters over one lazy plan. A job that writes both within a micro-batch should
    persist the messages first (see ``streaming.sinks.write_all``).
    """
    text = df.select(*df.columns, F.json_tuple("value", *fields).alias(*[f"_{f}" for f in fields]))
    required = [f.name for f in schema.fields if not f.nullable and f.name in cols]
    value = F.col("value")
    nested = _nested([f for f in fields if f != "payload"])  # a payload may be anything
    ok = ~nested
    odd = F.lit("")
    if strict:
        odd = _not_text([f for f in fields if f not in schema.names or isinstance(schema[f].dataType, T.StringType)])
        ok = ok & (odd == "")
    for n in required:
        ok = ok & cols[n].isNotNull()
    missing = F.concat_ws(",", *[F.when(cols[n].isNull(), F.lit(n)) for n in required])
    reason = (F.when(value.isNull(), F.lit("null value"))
              .when(F.json_object_keys(value).isNull(), F.lit("not a JSON object"))
              .when(nested, F.lit("object or array in a text field"))
              .when(odd != "", F.concat(F.lit("not a string: "), odd))
              .otherwise(F.concat(F.lit("missing or invalid: "), missing)))
    rejects = text.where(~ok).select(*df.columns, reason.alias(ERROR))
    out = [c.alias(n) for n, c in cols.items()]
    if mode == "quarantine":
        return Parsed(text.where(ok).select(*out), rejects)
    if mode == "fail":
        first = required[0]
        raised = F.raise_error(F.concat(F.lit("bad message, "), reason)).cast(schema[first].dataType)
        out = [F.when(ok, c).otherwise(raised).alias(n) if n == first else c.alias(n)
               for n, c in cols.items()]
        return Parsed(text.select(*out), rejects)
    raise ValueError(f"mode must be 'quarantine' or 'fail', got {mode!r}")


def _nested(fields: list[str]) -> Column:
    """Whether a field holds an object or an array. Their text starts with a bracket, as a string may as
    well; only then the message is looked at again. Numbers and booleans count as their text, and
    what follows a complete object is ignored."""
    some = found = F.lit(False)
    for f in fields:
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("value"), f"$.{f}", "variant"))
        text = F.col(f"_{f}")
        bracket = F.coalesce(text.startswith("{") | text.startswith("["), F.lit(False))
        some = some | bracket
        found = found | bracket & F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
    return some & found


def _not_text(fields: list[str]) -> Column:
    """Comma-separated names of fields that hold anything but a string or null."""
    message = F.try_parse_json("value")
    kinds = {f: F.schema_of_variant(F.try_variant_get(message, f"$.{f}", "variant")) for f in fields}
    return F.concat_ws(",", *[F.when(~kind.isin("STRING", "VOID"), F.lit(f)) for f, kind in kinds.items()])


def _text(*names: str) -> dict[str, Column]:
    return {n: F.col(f"_{n}") for n in names}


def parse_events(df: DataFrame, mode: str = "quarantine", strict: bool = False) -> Parsed:
    """Event messages to in-flight rows; a missing product id stays NULL."""
    cols = _text("event_id", "user_id", "event_type", "product_id")
    cols["event_time"] = parse_time(F.col("_timestamp"))
    return _parse(df, ["event_id", "user_id", "event_type", "product_id", "timestamp"], cols,
                  S.EVENT_ROW, mode, strict)


def parse_products(df: DataFrame, mode: str = "quarantine", strict: bool = False) -> Parsed:
    """Product messages; a quoted price counts as a number."""
    cols = _text("product_id", "product_name")
    cols["price"] = F.col("_price").try_cast("double")
    cols["category"] = F.col("_category")
    cols["timestamp"] = parse_time(F.col("_timestamp"))
    return _parse(df, ["product_id", "product_name", "price", "category", "timestamp"], cols,
                  S.PRODUCT_ROW, mode, strict)


def parse_profiles(df: DataFrame, mode: str = "quarantine", strict: bool = False) -> Parsed:
    """Profile messages; the registration date stays text until the sink."""
    cols = _text("user_id", "username", "user_segment", "registration_date")
    cols["timestamp"] = parse_time(F.col("_timestamp"))
    return _parse(df, [*PROFILE_FIELDS, "timestamp"], cols, S.PROFILE_ROW, mode, strict)


def flatten_events(df: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Event messages to the flat table; here a missing product id is an empty string."""
    rows = parse_events(df, mode).rows
    return rows.select("event_id", "user_id", "event_type",
                       F.coalesce("product_id", F.lit("")).alias("product_id"),
                       F.col("event_time").alias("timestamp"),
                       F.current_timestamp().alias("processing_time"))


def parse_generic(df: DataFrame, mode: str = "quarantine") -> Parsed:
    cols = {"event_time": parse_time(F.col("_timestamp")),
            "processing_time": F.current_timestamp(), "payload": F.col("value")}
    return _parse(df, ["timestamp"], cols, S.GENERIC, mode)


def generic_events(df: DataFrame, mode: str = "quarantine", as_variant: bool = False) -> DataFrame:
    """Keep the whole message text as received, next to its event time."""
    rows = parse_generic(df, mode).rows
    if as_variant:
        rows = rows.withColumn("payload", F.try_parse_json("payload"))
    return rows


def parse_profile_records(df: DataFrame, mode: str = "quarantine") -> Parsed:
    cols = _text("user_id", "username", "user_segment")
    cols["registration_date"] = parse_date(F.col("_registration_date"))
    cols["timestamp"] = parse_time(F.col("_timestamp"))
    cols["processing_time"] = F.current_timestamp()
    return _parse(df, [*PROFILE_FIELDS, "timestamp"], cols, S.USER_PROFILES, mode)


def profile_records(df: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Profile messages to the profile table."""
    return parse_profile_records(df, mode).rows


def product_records(df: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Product messages to the product table."""
    return parse_products(df, mode).rows.withColumn("processing_time", F.current_timestamp())


def parse_payload(df: DataFrame, fn=None, mode: str = "quarantine") -> Parsed:
    """User hook: text in, record text out, then read the record as the generic table.

    ``fn`` maps a Column to a Column; an Arrow-backed ``pandas_udf`` of str -> str fits as well. A Python
    function wrapped in ``Isolated`` may raise: such messages are rejects and the others go on. The record holds event_time, processing_time and payload. Without ``fn`` the message itself is the
    payload (:func:`parse_generic`). A message whose record lacks the event time is a reject; a missing
    processing time is now.
    """
    if fn is None:
        return parse_generic(df, mode)
    names = ["event_time", "processing_time", "payload"]
    made = fn(F.col("value"))
    if isinstance(fn, Isolated):
        fn.ship(df.sparkSession)
        done = df.withColumn("_message", F.col("value")).withColumn("_made", made)
        failed = done.where("_made.error is not null")
        done = done.where("_made.error is null").withColumn("value", F.col("_made.record")).drop("_made")
    else:
        failed, done = None, df.withColumn("_message", F.col("value")).withColumn("value", made)
    cols = {"event_time": parse_time(F.col("_event_time")),
            "processing_time": F.coalesce(parse_time(F.col("_processing_time")),
                                          F.current_timestamp()),
            "payload": F.col("_payload")}
    parsed = _parse(done, names, cols, S.GENERIC, mode)
    message = [F.col("_message").alias(c) if c == "value" else F.col(c) for c in df.columns]
    back = parsed.rejects.select(*message, ERROR)
    if failed is not None:
        back = back.unionByName(failed.select(*message, F.concat(
            F.lit("function failed: "), F.col("_made.error")).alias(ERROR)))
    return Parsed(parsed.rows, back)


def apply_payload_fn(df: DataFrame, fn=None, mode: str = "quarantine") -> DataFrame:
    """The rows of :func:`parse_payload`."""
    return parse_payload(df, fn, mode).rows


def to_messages(df: DataFrame, key_col: str) -> DataFrame:
    """Rows to key/value messages, the value being the whole row as JSON text."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))
