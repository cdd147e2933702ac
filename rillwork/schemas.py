"""Row and table schemas, and the cast + null contract that sinks apply.

Field names, types and modes are fixed values: they are the tables' public contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampType(),
          "date": T.DateType(), "int": T.IntegerType(), "bigint": T.LongType(), "variant": T.VariantType()}


def _schema(**fields: str) -> T.StructType:
    """``name="type"`` or ``name="type!"``; the mark means REQUIRED."""
    return T.StructType([T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
                         for name, kind in fields.items()])


# Message envelope, the same columns for a broker topic and for replayed files.
ENVELOPE = _schema(key="string", value="string", topic="string", partition="int",
                   offset="bigint", timestamp="timestamp")

# In-flight rows.
EVENT_ROW = _schema(event_id="string!", user_id="string!", event_type="string!",
                    product_id="string", event_time="timestamp!")
PRODUCT_ROW = _schema(product_id="string!", product_name="string!", price="double!",
                      category="string!", timestamp="timestamp!")
PROFILE_ROW = _schema(user_id="string!", username="string!", user_segment="string!",
                      registration_date="string!", timestamp="timestamp!")

# Sink tables.
USER_EVENTS = _schema(event_id="string!", user_id="string!", event_type="string!",
                      product_id="string", timestamp="timestamp!", processing_time="timestamp!")
GENERIC = _schema(event_time="timestamp!", processing_time="timestamp!", payload="string")
GENERIC_JSON = _schema(event_time="timestamp!", processing_time="timestamp!", payload="variant")
EVENT_COUNTS = _schema(event_type="string!", event_count="bigint!", window_start="timestamp!",
                       window_end="timestamp!", processing_time="timestamp!")
USER_PROFILES = _schema(user_id="string!", username="string!", user_segment="string!",
                        registration_date="date!", timestamp="timestamp!",
                        processing_time="timestamp!")
PRODUCT_UPDATES = _schema(product_id="string!", product_name="string!", price="double!",
                          category="string!", timestamp="timestamp!",
                          processing_time="timestamp!")
ENRICHED_EVENTS = _schema(event_id="string!", user_id="string!", event_type="string!",
                          event_timestamp="timestamp!", product_id="string",
                          product_name="string", price="double", category="string",
                          username="string", user_segment="string", registration_date="date",
                          processing_time="timestamp!")

# Day-partitioning column of each sink; None means the table is not partitioned.
PARTITION_BY = {
    "user_events": None,
    "generic": "event_time",
    "user_event_aggregations": "window_start",
    "user_profiles": None,
    "enriched_events": "processing_time",
}


def _cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return col
    if isinstance(target, T.VariantType) and isinstance(source, T.StringType):
        return F.try_parse_json(col)
    return col.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, on_null: str = "fail") -> DataFrame:
    """Select, cast and order columns as declared.

    Spark does not enforce nullability on write, so a NULL in a REQUIRED column raises here;
    ``on_null='keep'`` leaves it in place, for :func:`violations` to name it.
    """
    source = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        col = _cast(F.col(f.name), source[f.name], f.dataType)
        if not f.nullable and on_null == "fail":
            broken = F.raise_error(F.lit(f"NULL in required column {f.name}")).cast(f.dataType)
            col = F.coalesce(col, broken)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def violations(df: DataFrame, schema: T.StructType) -> Column:
    """Comma-separated names of REQUIRED columns that are NULL; NULL if the row is fine."""
    source = {f.name: f.dataType for f in df.schema.fields}
    missing = F.concat_ws(",", *[
        F.when(_cast(F.col(f.name), source[f.name], f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields if not f.nullable and f.name in source])
    return F.nullif(missing, F.lit(""))
