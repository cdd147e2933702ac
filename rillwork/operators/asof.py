"""As-of lookup: each event gets the latest version of its key known at the event's time.

Time is cut into slices, and the work is one window function per (key, slice) instead of one per
key, so a key with a third of all rows is spread over all its slices. Slices that hold more than
``hot_rows`` events and versions are cut into finer ones by time, so versions are never repeated:

1. versions of one key and time are reduced to the last of them;
2. per (key, slice), the last version inside the slice (partially aggregated);
3. per key, the last version before each slice, carried over the aggregated rows. Such a group has
   one row per slice, however many events there are;
4. events, versions and carried versions meet in (key, slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillwork.functions import window_of
from rillwork.operators import skew

# At one instant: carried versions first, then versions, then events.
CARRIED, VERSION, EVENT = 0, 1, 2


def asof_join(events: DataFrame, versions: DataFrame, key: str, event_time: Column,
              version_time: str, cols: list[str], slice_width: str = "1 day",
              hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """All event columns plus ``cols`` of the latest version at or before ``event_time``.

    Versions with equal times are ordered by ``cols``. Without a version ``cols`` are NULL.
    """
    row = F.struct(*[F.col(c) for c in events.columns])
    ev = events.select(F.col(key).alias("_key"), event_time.alias("_t"), row.alias("_row"))
    ve = (versions.groupBy(F.col(key).alias("_key"), F.col(version_time).alias("_t"))
          .agg(F.max(F.struct(*cols)).alias("_v"))
          .select("_key", "_t", F.struct(F.col("_t").alias("t"), "_v.*").alias("_v")))
    no_version = F.lit(None).cast(ve.schema["_v"].dataType)
    no_row = F.lit(None).cast(ev.schema["_row"].dataType)
    ev, ve, units = _sliced(ev, ve, slice_width, hot_rows)

    # One row per (key, slice) from each side. An event slice sorts before the versions of the same
    # slice, so the rows before it hold the versions of earlier slices only.
    unit = ["_key", "_slice", "_fine"]
    marks = (units.select(*unit, no_version.alias("_v"), F.lit(1).alias("_own"))
             .unionByName(ve.groupBy(*unit).agg(F.max("_v").alias("_v")).withColumn("_own", F.lit(0))))
    before = (Window.partitionBy("_key").orderBy("_slice", "_fine", F.col("_own").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = marks.withColumn("_v", F.last("_v", ignorenulls=True).over(before))
    carried = carried.where((F.col("_own") == 1) & F.col("_v").isNotNull()).select(
        *unit, F.col("_slice").alias("_t"), no_row.alias("_row"), "_v", F.lit(CARRIED).alias("_kind"))
    facts = carried.unionByName(ve.select(*unit, "_t", no_row.alias("_row"), "_v",
                                          F.lit(VERSION).alias("_kind")))
    ev = ev.select(*unit, "_t", "_row", no_version.alias("_v"), F.lit(EVENT).alias("_kind"))

    so_far = (Window.partitionBy(*unit).orderBy("_kind_first", "_t", "_kind", "_v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A carried version comes before all that happens in its slice.
    known = (ev.unionByName(facts).withColumn("_kind_first", F.col("_kind") != CARRIED)
             .withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)))
    return known.where(F.col("_kind") == EVENT).select(
        *[F.col(f"_row.{c}").alias(c) for c in events.columns],
        *[F.col(f"_v.{c}").alias(c) for c in cols])


def _sliced(ev: DataFrame, ve: DataFrame, width: str, hot_rows: int | None
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides with their slice and, in hot slices, the finer cut within it; and the distinct
    (key, slice, cut) of the events.

    Events are counted once, per slice: the same shuffle gives the hot slices and the slices that stay
    whole. Only events of hot slices are gone through again for their finer cuts; if no slice is hot,
    adaptive execution leaves that out.
    """
    span = window_of(F.col("_t"), width)
    start, end = F.unix_micros(span["start"]), F.unix_micros(span["end"])
    ev, ve = (df.withColumns({"_slice": span["start"], "_width": end - start,
                              "_past": F.unix_micros("_t") - start}) for df in (ev, ve))
    at = ["_key", "_slice"]
    if hot_rows is None:
        return (*(df.withColumn("_fine", F.lit(0)) for df in (ev, ve)),
                ev.select(*at).distinct().withColumn("_fine", F.lit(0)))
    counted, versions = (df.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")) for df in (ev, ve))
    hot = (counted.unionByName(versions).groupBy(*at).agg(F.sum("_n").alias("_n"))
           .where(F.col("_n") > hot_rows)
           .select(*at, F.ceil(F.col("_n") / hot_rows).alias("_parts")))
    hot = F.broadcast(hot)  # an entry per ``hot_rows`` rows, see ``skew``
    fine = F.floor(F.col("_past") * F.col("_parts") / F.col("_width"))
    cut = fine.cast("int").alias("_fine")
    # The count is read here too, so that both uses are one shuffle.
    whole = counted.where("_n > 0").join(hot, at, "left_anti").select(*at, F.lit(0).alias("_fine"))
    finer = ev.join(hot, at).select(*at, cut).distinct()
    return (*(df.join(hot, at, "left").withColumn("_fine", F.coalesce(fine, F.lit(0)).cast("int"))
              for df in (ev, ve)), whole.unionByName(finer))
