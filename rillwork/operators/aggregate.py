"""Windowed counts, keep-latest and column-wise maxima.

Each one aggregates partially before its shuffle, so a key with a third of all rows arrives at
its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from rillwork.functions import window_of

# Total order of profile versions of one user; the later columns only break timestamp ties.
PROFILE_ORDER = ["timestamp", "username", "user_segment", "registration_date"]


def count_by_window(df: DataFrame, time_col: str = "event_time", width: str = "1 minute",
                    delay: str | None = None) -> DataFrame:
    """Rows per event type and tumbling window. Streams need a watermark ``delay``."""
    if df.isStreaming:
        df = df.withWatermark(time_col, delay or "1 minute")
    counted = (df.groupBy("event_type", window_of(F.col(time_col), width).alias("_w"))
               .agg(F.count(F.lit(1)).alias("event_count")))
    return counted.select("event_type", "event_count", F.col("_w.start").alias("window_start"),
                          F.col("_w.end").alias("window_end"))


def aggregation_records(counts: DataFrame) -> DataFrame:
    """Window counts to the aggregation table."""
    return counts.select("event_type", "event_count", "window_start", "window_end",
                         F.current_timestamp().alias("processing_time"))


def latest_by(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_cols``.

    All remaining columns extend the order, so the winner never depends on row order. Columns
    must be orderable (no maps).
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    best = F.max(F.struct(*order_cols, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def latest_profiles(profiles: DataFrame) -> DataFrame:
    return latest_by(profiles.select("user_id", *PROFILE_ORDER), ["user_id"], PROFILE_ORDER)


def colwise_max(df: DataFrame, keys: list[str]) -> DataFrame:
    """MAX of each column on its own. The result may be a row that no input row equals."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in df.columns if c not in keys])


def observe_lookups(df: DataFrame, matched_col: str, observation: Observation | str) -> DataFrame:
    """Count rows and lookup hits while the data passes; adds no job and no shuffle."""
    return df.observe(observation, F.count(F.lit(1)).alias("lookups"),
                      F.count_if(F.col(matched_col).isNotNull()).alias("hits"))


def lookup_hit_rate(df: DataFrame, matched_col: str) -> DataFrame:
    """The same counters as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("lookups"),
                  F.count_if(F.col(matched_col).isNotNull()).alias("hits"),
                  F.count_if(F.col(matched_col).isNull()).alias("misses"))
