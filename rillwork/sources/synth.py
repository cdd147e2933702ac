"""Sample records for the three topics, made by Spark from a row number and a seed.

Values come from a hash of (row, seed, field), so a run gives the same rows under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillwork.operators.parse import to_messages

# The domains of the sample records.
EVENT_TYPES = ["page_view", "add_to_cart", "purchase", "remove_from_cart"]
CATEGORIES = ["Electronics", "Books", "Clothing", "Home", "Sports"]
SEGMENTS = ["premium", "regular", "new"]
USERS, PRODUCTS = 100, 50
MIN_PRICE, MAX_PRICE = 10.0, 500.0
KEY_OF_TOPIC = {"user-events": "user_id", "product-updates": "product_id",
                "user-profiles": "user_id"}


def synth_topic(spark: SparkSession, topic: str, n: int, seed: int = 42,
                start: str = "2024-01-01 00:00:00", gap_seconds: float = 1.0) -> DataFrame:
    """``n`` records of a topic, ``gap_seconds`` apart."""
    if topic not in KEY_OF_TOPIC:
        raise ValueError(f"unknown topic {topic!r}")

    def draw(field: str, size: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(field)), F.lit(size))

    def pick(field: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (draw(field, len(values)) + 1).cast("int"))

    def numbered(prefix: str, field: str, size: int) -> Column:
        return F.format_string(prefix + "%03d", draw(field, size) + 1)

    micros = F.unix_micros(F.lit(start).cast("timestamp")) + (
        F.col("id") * int(gap_seconds * 1_000_000))
    at = F.timestamp_micros(micros)
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    user = numbered("user_", "user", USERS)
    product = numbered("prod_", "product", PRODUCTS).alias("product_id")
    if topic == "user-events":
        event_id = F.concat(F.lit("evt_"), F.substring(
            F.sha2(F.concat_ws(":", F.lit(seed), "id"), 256), 1, 8)).alias("event_id")
        cols = [event_id, user.alias("user_id"), pick("type", EVENT_TYPES).alias("event_type"),
                product, iso]
    elif topic == "product-updates":
        cents = F.lit(int(MIN_PRICE * 100)) + draw("price", int((MAX_PRICE - MIN_PRICE) * 100) + 1)
        cols = [product, numbered("Product ", "name", PRODUCTS).alias("product_name"),
                (cents / 100).alias("price"), pick("category", CATEGORIES).alias("category"), iso]
    else:
        day = F.date_sub(F.to_date(at), (draw("age", 365) + 1).cast("int")).cast("string")
        cols = [user.alias("user_id"),
                F.concat(F.lit("username_"), F.substring_index(user, "_", -1)).alias("username"),
                pick("segment", SEGMENTS).alias("user_segment"),
                day.alias("registration_date"), iso]
    return spark.range(n).select(*cols)


def synth_messages(spark: SparkSession, topic: str, n: int, seed: int = 42, **kw) -> DataFrame:
    """The same records as key/value messages."""
    return to_messages(synth_topic(spark, topic, n, seed, **kw), KEY_OF_TOPIC[topic])
