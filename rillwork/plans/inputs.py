"""The three topics and the profile table, derived from the given tables by Spark.

events  -> user-events messages (every row; errors name no product),
           product-updates messages (purchases, with name and category from part),
           user-profiles messages (sign-ups)
orders  -> the stored profile table: one profile version per order, with times as text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillwork.functions import to_json_text

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
STORED = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"
PARTITIONS = 4


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def _product_id() -> Column:
    return F.get_json_object("props", "$.k")


def _username(key: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _envelope(df: DataFrame, topic: str, key: Column, partition: Column, value: Column
              ) -> DataFrame:
    return df.select(key.alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
                     partition.cast("int").alias("partition"), F.col("event_id").alias("offset"),
                     F.col("ts").alias("timestamp"))


def event_value() -> Column:
    """Message text of an event row. NULL fields are left out of the JSON."""
    product = F.when(F.col("event_type") != "error", _product_id())
    return to_json_text(_text("event_id").alias("event_id"), _text("user_id").alias("user_id"),
                        "event_type", product.alias("product_id"),
                        F.date_format("ts", ISO).alias("timestamp"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(_events(spark, sf_dir))


def event_envelopes(ev: DataFrame) -> DataFrame:
    return _envelope(ev, "user-events", _text("user_id"), F.col("user_id") % PARTITIONS,
                     event_value())


def product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_envelopes(_events(spark, sf_dir), read(spark, sf_dir, "part"))


def product_envelopes(ev: DataFrame, part: DataFrame) -> DataFrame:
    bought = ev.where(F.col("event_type") == "purchase").withColumn("k", _product_id())
    part = part.select("p_partkey", "p_name", "p_type")
    named = bought.join(part, F.col("k").cast("bigint") == F.col("p_partkey"), "left")
    value = to_json_text(F.col("k").alias("product_id"), F.col("p_name").alias("product_name"),
                         F.col("value").alias("price"), F.col("p_type").alias("category"),
                         F.date_format("ts", ISO).alias("timestamp"))
    return _envelope(named, "product-updates", F.col("k"), F.col("k").cast("int") % PARTITIONS,
                     value)


def profile_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_envelopes(_events(spark, sf_dir))


def profile_envelopes(ev: DataFrame) -> DataFrame:
    signed = ev.where(F.col("event_type") == "signup")
    segment = (F.when(F.col("value") >= 100, "premium").when(F.col("value") >= 20, "regular")
               .otherwise("new"))
    value = to_json_text(_text("user_id").alias("user_id"), _username("user_id").alias("username"),
                         segment.alias("user_segment"),
                         F.date_format("ts", "yyyy-MM-dd").alias("registration_date"),
                         F.date_format("ts", ISO).alias("timestamp"))
    return _envelope(signed, "user-profiles", _text("user_id"), F.col("user_id") % PARTITIONS,
                     value)


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored profile versions, times as text."""
    orders = read(spark, sf_dir, "orders")
    return orders.select(
        _text("o_custkey").alias("user_id"), _username("o_custkey").alias("username"),
        F.col("o_orderpriority").alias("user_segment"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("registration_date"),
        F.date_format("o_orderdate", STORED).alias("timestamp"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages, damaged in a way that depends on the event type."""
    ev = _events(spark, sf_dir)
    kind, text = F.col("event_type"), event_value()
    broken = (F.when(kind == "signup", F.expr("substring(v, 1, length(v) - 1)"))
              .when(kind == "view", F.concat(F.lit("["), F.col("v"), F.lit("]")))
              .when(kind == "click", F.replace("v", F.lit('"user_id"'), F.lit('"user"')))
              .when(kind == "error", F.lit(None).cast("string"))
              .otherwise(F.col("v")))
    return _envelope(ev.withColumn("v", text), "user-events", _text("user_id"),
                     F.col("user_id") % PARTITIONS, broken)
