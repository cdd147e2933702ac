"""Ways to enrich events from a slowly changing profile table.

These are the batch forms, with the event time as the clock. ``rillwork.streaming`` holds the
forms that follow the wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillwork.functions import window_of
from rillwork.operators import skew
from rillwork.operators.aggregate import PROFILE_ORDER, colwise_max, latest_profiles
from rillwork.operators.asof import asof_join
from rillwork.operators.join import PROFILE_COLS, join_profiles, three_way

VERSION_COLS = ["user_id", *PROFILE_ORDER]


def enrich_static(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Lookup in one snapshot: the latest version of each user, read when the query starts."""
    return join_profiles(df, latest_profiles(profiles))


def all_profiles(snapshot: DataFrame, updates: DataFrame) -> DataFrame:
    """Bag union of the snapshot and the updates."""
    return snapshot.select(*VERSION_COLS).unionByName(updates.select(*VERSION_COLS))


def enrich_sql(events: DataFrame, products: DataFrame, snapshot: DataFrame, updates: DataFrame,
               width: str = "1 minute", dedup: str = "colwise_max",
               hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """Union snapshot and updates, keep one profile per user, join all three.

    ``dedup='colwise_max'`` takes the maximum of each column on its own and may mix versions;
    ``'latest'`` keeps a version that exists.
    """
    profiles = all_profiles(snapshot, updates)
    if dedup == "colwise_max":
        one = colwise_max(profiles, ["user_id"])
    elif dedup == "latest":
        one = latest_profiles(profiles)
    else:
        raise ValueError(f"dedup must be 'colwise_max' or 'latest', got {dedup!r}")
    return three_way(events, products, one, width, hot_rows)


def enrich_hybrid(events: DataFrame, snapshot: DataFrame, updates: DataFrame,
                  slice_width: str = "1 day", hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """Latest update at or before the event, else the snapshot's profile.

    The snapshot is known from the start: it counts as older than every update, whatever their times.
    """
    live = updates.select("user_id", F.col("timestamp").alias("_from"), *PROFILE_COLS)
    seen = asof_join(events, live, "user_id", F.col("event_time"), "_from", ["_from", *PROFILE_COLS],
                     slice_width, hot_rows)
    base = latest_profiles(snapshot).select(
        F.col("user_id").alias("_u"), *[F.col(c).alias(f"_s_{c}") for c in PROFILE_COLS])
    both = seen.join(base, F.col("user_id") == F.col("_u"), "left")
    found = F.col("_from").isNotNull()
    return both.select(*events.columns, *[
        F.when(found, F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in PROFILE_COLS])


def enrich_refreshing(events: DataFrame, versions: DataFrame, every: str = "30 minutes",
                      slice_width: str = "1 day",
                      hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """Lookup in a snapshot that is renewed at every full period: an event sees the versions
    written up to the last renewal before it."""
    return asof_join(events, versions, "user_id", window_of(F.col("event_time"), every)["start"],
                     "timestamp", PROFILE_COLS, slice_width, hot_rows)


def enrich_lookup(df: DataFrame, dim: DataFrame, default: dict[str, str] | None = None
                  ) -> DataFrame:
    """Look up just the users that occur in ``df``, with defaults for users that are not found.

    The distinct users (partially aggregated) reduce the dimension by a semi-join before it is
    deduplicated; the join on the result is the only shuffle of ``df``.
    """
    users = df.select("user_id").distinct()
    wanted = dim.select(*VERSION_COLS).join(users, "user_id", "left_semi")
    out = join_profiles(df, latest_profiles(wanted).withColumn("_found", F.lit(True)))
    if not default:
        return out
    return out.select(*[F.coalesce(c, F.lit(default[c])).alias(c) if c in default else F.col(c)
                        for c in out.columns])


def point_lookup(dim: DataFrame, user_id) -> DataFrame:
    """The profile of one user, newest row first. A literal ``user_id`` of the stored type is an
    equality filter that reaches the scan; a cast or a subquery is compared after it."""
    order = [F.col(c).desc() for c in PROFILE_ORDER]
    return dim.where(F.col("user_id") == user_id).orderBy(*order).limit(1)


def fallback(df: DataFrame, sources: list[tuple[str, DataFrame]],
             default: dict[str, str] | None = None) -> DataFrame:
    """First source that knows the user wins; ``profile_source`` names it.

    The sources are reduced to one row per user before the single join with ``df``.
    """
    ranked = None
    for rank, (name, dim) in enumerate(sources):
        part = latest_profiles(dim).select(
            "user_id", F.lit(rank).alias("_rank"), F.lit(name).alias("profile_source"),
            *PROFILE_COLS)
        ranked = part if ranked is None else ranked.unionByName(part)
    best = ranked.groupBy("user_id").agg(
        F.min(F.struct("_rank", "profile_source", *PROFILE_COLS)).alias("_b"))
    dim = best.select(F.col("user_id").alias("_u"),
                      *[F.col(f"_b.{c}").alias(c) for c in ("profile_source", *PROFILE_COLS)])
    out = df.join(dim, F.col("user_id") == F.col("_u"), "left").drop("_u")
    fill = {"profile_source": "default", **(default or {})}
    return out.select(*[F.coalesce(c, F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                        for c in out.columns])
