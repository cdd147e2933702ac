"""A profile cache in keyed state (RocksDB state store), one entry per user and part."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillwork.operators.aggregate import latest_profiles
from rillwork.operators.join import PROFILE_COLS, join_profiles

# Python workers get this module's code with the task; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# No leading underscores: the state worker would rename such columns.
TIME, PART = "row_time", "state_part"
_CELL = "micros bigint, username string, user_segment string, registration_date string"


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype("int64")


class CachedProfiles(StatefulProcessor):
    """A profile is kept for ``ttl_ms`` after it was taken from the row's candidate.

    A miss is not kept. With ``cleanup`` the state store drops expired cells by itself. On the event
    clock rows are taken in time order within an Arrow chunk and else in order of arrival; what a cache
    holds depends on when it was asked.
    """

    def __init__(self, event_cols: list[str], ttl_ms: int, cleanup: bool):
        self.event_cols, self.ttl_ms, self.cleanup = event_cols, ttl_ms, cleanup

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = handle.getValueState("profile", _CELL, self.ttl_ms if self.cleanup else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        ttl = self.ttl_ms * 1000
        cached = tuple(self.cell.get()) if self.cell.exists() else None
        start = cached
        for chunk in rows:
            chunk = chunk.sort_values(TIME, kind="stable", ignore_index=True)
            now = _micros(chunk[TIME])
            found = chunk[PROFILE_COLS[0]].notna().to_numpy()
            candidates = chunk[PROFILE_COLS].to_numpy(dtype=object)
            profile = np.full((len(chunk), len(PROFILE_COLS)), None, dtype=object)
            i = 0
            while i < len(chunk):
                if cached is not None and now[i] < cached[0] + ttl:
                    until = int(np.searchsorted(now, cached[0] + ttl))
                    profile[i:until] = cached[1:]
                    i = until
                elif found[i]:
                    cached = (int(now[i]), *candidates[i])
                else:
                    i += 1
            out = chunk[self.event_cols].copy()
            for j, c in enumerate(PROFILE_COLS):
                out[c] = profile[:, j]
            yield out
        if cached is not start:
            self.cell.update(cached)


def _output_schema(events: DataFrame) -> T.StructType:
    fields = [f for f in events.schema.fields if f.name not in PROFILE_COLS]
    return T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in PROFILE_COLS]])


def _part_of(events: DataFrame, parts: int) -> Column:
    return F.pmod(F.xxhash64(*events.columns), F.lit(parts)).cast("int")


def enrich_cached_stream(events: DataFrame, profiles: DataFrame, ttl_ms: int,
                         clock: str = "processing", parts: int = 4, cleanup: bool = False
                         ) -> DataFrame:
    """Events with a profile that is taken from ``profiles`` and then kept for ``ttl_ms``.

    ``clock='processing'`` reads the time of the micro-batch, ``'event'`` the rows' own times. A
    task cannot start a lookup, so the candidate is joined in first. With ``parts`` a hot user has
    that many cache entries, each with its own expiry. ``cleanup`` lets the state store drop
    expired cells; such a query does not end under an ``availableNow`` trigger.
    """
    if clock not in ("processing", "event"):
        raise ValueError(f"clock must be 'processing' or 'event', got {clock!r}")
    now = F.current_timestamp() if clock == "processing" else F.col("event_time")
    event_cols = events.columns
    joined = join_profiles(events, latest_profiles(profiles), parts)
    keyed = joined.select("*", now.alias(TIME), _part_of(events, parts).alias(PART)).groupBy(
        "user_id", PART)
    return keyed.transformWithStateInPandas(
        CachedProfiles(event_cols, ttl_ms, cleanup), _output_schema(events), "append",
        "ProcessingTime" if cleanup else "None")
