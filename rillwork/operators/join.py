"""Joins of events with product updates and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillwork.functions import copy_block, parse_date, window_of
from rillwork.operators import blocks, skew

PRODUCT_COLS = ["product_id", "product_name", "price", "category"]
PROFILE_COLS = ["username", "user_segment", "registration_date"]

#: Groups that events without product id are dealt into where they pass through a stream's join.
ALONE = 65_536

_WINDOW = "_window"
_P = "_p_"


def _windowed(events: DataFrame, products: DataFrame, width: str, delay: str | None, marked: bool):
    """Both sides with a window column; product columns renamed so that they stay distinct.
    ``marked``: the events' time already carries a watermark, that of a stateful operator before."""
    prods = products.select(*[F.col(c).alias(_P + c) for c in products.columns])
    if events.isStreaming or prods.isStreaming:
        # Watermark a copy of the time and window the copy: two event-time columns in one row
        # would be refused.
        delay = delay or "1 minute"
        if marked:
            # The window carries the mark on; one column of a row may have it.
            ev = events.withColumn(_WINDOW, window_of(F.col("event_time"), width)).withColumn(
                "event_time", F.col("event_time").alias("event_time", metadata={}))
        else:
            ev = (events.withColumn("_t", F.col("event_time")).withWatermark("_t", delay)
                  .withColumn(_WINDOW, window_of(F.col("_t"), width)).drop("_t"))
        prods = (prods.withColumn("_t", F.col(_P + "timestamp")).withWatermark("_t", delay)
                 .withColumn(_WINDOW, window_of(F.col("_t"), width)).drop("_t"))
        return ev, prods
    # Batch: the start alone identifies the window and shuffles as one long.
    ev = events.withColumn(_WINDOW, window_of(F.col("event_time"), width)["start"])
    prods = prods.withColumn(_WINDOW, window_of(F.col(_P + "timestamp"), width)["start"])
    return ev, prods


def left_join_in_window(events: DataFrame, products: DataFrame, width: str = "1 minute",
                        delay: str | None = None, hot_rows: int | None = skew.HOT_ROWS,
                        spread: int = 4, marked: bool = False, pairs: int = skew.PAIRS) -> DataFrame:
    """All event columns, plus the product columns of each match under a ``_p_`` prefix.

    Equi-join on product id inside one tumbling window, many-to-many. Events without a product id match
    nothing: they go around the join, without shuffle and without state. Batch: (id, window)
    groups above ``hot_rows`` products are split, and events repeated at most ``spread`` times more often than
    there are products for each; groups of events are split by adaptive execution. A join of more than ``pairs``
    pairs, which a job counts at once, is dealt over tasks of about that many. ``None`` skips the counts. Streams: each group is spread over ``spread`` parts and the product
    side is repeated that often; both sides are packed into blocks of rows, which are joined, and unpacked to
    pairs (:mod:`~rillwork.operators.blocks`). ``marked``: the events come from a stateful operator; going around the join would
    run that operator twice, so events without product id pass through it, dealt out by hash.
    """
    no_id = F.col("product_id").isNull()
    blank = {f"{_P}{c}": F.lit(None).cast(products.schema[c].dataType).alias(f"{_P}{c}")
             for c in PRODUCT_COLS}
    around = events.where(no_id).select(*events.columns, *blank.values())
    ev, prods = _windowed(events if marked else events.where(~no_id), products, width, delay, marked)
    keys = ["product_id", _WINDOW]
    prods = prods.withColumnRenamed(_P + "product_id", "product_id").where(
        F.col("product_id").isNotNull())
    if ev.isStreaming or prods.isStreaming:
        joined = _join_blocks(ev, prods, keys, events.columns, spread, no_id if marked else None)
        joined = joined.select(*events.columns, *blank)
        return joined if marked else joined.unionByName(around)
    if hot_rows is None:
        lhs, rhs, on = ev, prods, keys
    elif (count := skew.tasks_for(ev, prods, keys, hot_rows, pairs))[0] > 1:
        tasks, split = count
        lhs, rhs = skew.deal(ev, prods, keys, hot_rows, spread, pairs) if split else (ev, prods)
        on = [*keys, skew.RIGHT_PART, skew.LEFT_PART] if split else keys
        # A number keeps adaptive execution from merging partitions that read little and return much.
        tasks = max(tasks, ev.sparkSession.sparkContext.defaultParallelism)
        lhs, rhs = lhs.repartition(tasks, *on), rhs.repartition(tasks, *on)
    else:
        hot = skew.hot_groups(ev, prods, keys, hot_rows, spread)
        lhs, rhs = skew.split_right(ev, prods, keys, hot, prods.columns)
        on = [*keys, skew.RIGHT_PART]
    rhs = rhs.select(*[F.col(c).alias("_k" + c) for c in on],
                     F.col("product_id").alias(_P + "product_id"),
                     *[c for c in rhs.columns if c.startswith(_P)])
    joined = _left_join(lhs, rhs, on)
    if "_parts" in lhs.columns:
        joined = joined.where((F.col("_parts") == 1) | F.col("_kproduct_id").isNotNull())
    return joined.select(*events.columns, *blank).unionByName(around)


def _left_join(lhs: DataFrame, rhs: DataFrame, on: list[str]) -> DataFrame:
    cond = F.lit(True)
    for c in on:
        cond = cond & (F.col(c) == F.col("_k" + c))
    return lhs.join(rhs, cond, "left")


def _join_blocks(ev: DataFrame, prods: DataFrame, keys: list[str], event_cols: list[str], spread: int,
                 alone: Column | None) -> DataFrame:
    """The left join of two streams. Products are dealt over as many tasks as events are, then their blocks are
    repeated for each part of the events. ``alone``: events that match nothing, in parts of their own."""
    part = skew.part_of(event_cols, F.lit(spread))
    if alone is not None:
        part = F.when(alone, skew.part_of(event_cols, F.lit(ALONE)) + spread).otherwise(part)
    on = [*keys, skew.LEFT_PART]
    lhs = blocks.pack(ev.withColumn(skew.LEFT_PART, part), on, event_cols, "_events")
    dealt = prods.withColumn(skew.RIGHT_PART, skew.part_of(prods.columns, F.lit(spread)))
    rhs = blocks.pack(dealt, [*keys, skew.RIGHT_PART], [_P + c for c in PRODUCT_COLS if c != "product_id"], "_products")
    rhs = rhs.select(*[F.col(c).alias("_k" + c) for c in keys], "_products",
                     skew.every_part(F.lit(spread)).alias("_k" + skew.LEFT_PART))
    pairs = _left_join(lhs, rhs, on).select(
        F.inline("_events"), F.col("_kproduct_id").alias(_P + "product_id"), "_products")
    return pairs.select(*event_cols, _P + "product_id", F.inline_outer("_products"))


def join_in_window(events: DataFrame, products: DataFrame, width: str = "1 minute",
                   delay: str | None = None, hot_rows: int | None = skew.HOT_ROWS,
                   spread: int = 4, keep: Sequence[str] = (), pairs: int = skew.PAIRS) -> DataFrame:
    """Events with the product updates of their window.

    The product id comes from the product side: an unmatched event has none. ``keep`` names event columns to carry
    along: a lookup per event belongs before this join, which may give many rows per event.
    """
    joined = left_join_in_window(events, products, width, delay, hot_rows, spread, pairs=pairs)
    return joined.select("event_id", "user_id", "event_type",
                         F.col("event_time").alias("event_timestamp"),
                         *[F.col(_P + c).alias(c) for c in PRODUCT_COLS], *keep)


def join_profiles(events: DataFrame, profiles: DataFrame, spread: int = 1) -> DataFrame:
    """Left join with a dimension that has one row per user.

    No hint: Spark broadcasts the dimension when it is below ``autoBroadcastJoinThreshold`` and
    otherwise shuffles both sides. In a batch adaptive execution then splits a hot user's rows. A
    stream has none: there ``spread`` parts per user keep a hot one off a single task, and the
    dimension is repeated that often.
    """
    dim = profiles.select(F.col("user_id").alias("_u"), *PROFILE_COLS)
    same = F.col("user_id") == F.col("_u")
    if spread > 1:
        dim = dim.select("*", skew.every_part(F.lit(spread)).alias("_up"))
        events_cols, same = events.columns, same & (F.col("_ep") == F.col("_up"))
        events = events.withColumn("_ep", skew.part_of(events_cols, F.lit(spread)))
    return events.join(dim, same, "left").drop("_u", "_up", "_ep")


def three_way(events: DataFrame, products: DataFrame, profiles: DataFrame,
              width: str = "1 minute", hot_rows: int | None = skew.HOT_ROWS,
              delay: str | None = None, spread: int = 4) -> DataFrame:
    """Events as they are, plus product and profile columns; the event keeps its own product id.

    Profiles are joined first: events are shuffled and sorted by user, not their matches, of which there may be
    many per event. ``delay`` and ``spread`` are for streams, see :func:`left_join_in_window`.
    """
    streaming = events.isStreaming or products.isStreaming
    known = join_profiles(events, profiles, spread if streaming else 1)
    out = left_join_in_window(known, products, width, delay, hot_rows, spread)
    return out.select(*events.columns, F.col(_P + "product_name").alias("product_name"),
                      F.col(_P + "category").alias("category"), "username", "user_segment")


def enriched_records(enriched: DataFrame) -> DataFrame:
    """Enriched rows to the sink table.

    Product columns are kept only with a product id, profile columns only with a username. The
    processing time is stamped here, once.
    """
    profile = copy_block(F.col("username"), PROFILE_COLS[:2])
    date = parse_date(F.col("registration_date").cast("string"))
    return enriched.select("event_id", "user_id", "event_type", "event_timestamp",
                           *copy_block(F.col("product_id"), PRODUCT_COLS), *profile,
                           F.when(F.col("username").isNotNull(), date).alias("registration_date"),
                           F.current_timestamp().alias("processing_time"))
