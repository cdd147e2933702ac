"""Profile lookups on the event clock, in cells of keyed state (RocksDB state store).

Users are dealt into cells by hash. A cell holds the events that the watermark has not passed yet, the profile
versions that may still be needed and what a rule remembers, each as Arrow data, so a micro-batch costs a few
state calls per cell, not per user or event. Once the watermark has passed an event no earlier row can arrive:
the event is answered from the versions up to its time. So results depend on times alone, not on chunks, files,
micro-batches or the order of arrival.

One timer per cell stands at the earliest thing to do: the first waiting event, or a rule's own time
(an entry that expires). ``parts`` spreads a hot user's events over that many cells; its versions
go to each of them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillwork.operators.aggregate import colwise_max, latest_profiles
from rillwork.operators.join import PROFILE_COLS

# Python workers get this module's code with the task; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# No leading underscores: the state worker would rename such columns.
KIND, TIME, CELL = "row_kind", "row_time", "state_cell"
UPDATE, EVENT = 0, 1
USER, MICROS = "user_id", "micros"
#: Versions of the snapshot are older than every update.
ALWAYS = -2 ** 62
#: Cells that users are dealt into; a cell's waiting events and versions fit in a worker's memory.
CELLS = 64


def packed(df: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(df, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(rows, columns: list[str]) -> pd.DataFrame:
    """All packed tables of a list, one after the other."""
    parts = [pa.ipc.open_stream(bytes(r[-1])).read_pandas() for r in rows]
    if not parts:
        return pd.DataFrame({c: pd.Series([], dtype="int64" if c == MICROS else object) for c in columns})
    return pd.concat(parts, ignore_index=True)[columns]


def micros_of(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype("int64")


def texts(df: pd.DataFrame) -> pd.DataFrame:
    """Missing text as None."""
    return df.astype(object).where(df.notna(), None)


def version_of(events: pd.DataFrame, versions: pd.DataFrame) -> np.ndarray:
    """For each event (by time) the row number of its user's last version (sorted by time) up to
    then, -1 if there is none."""
    if not len(versions):
        return np.full(len(events), -1)
    users, names = pd.factorize(versions[USER])
    code = pd.Index(names).get_indexer(events[USER])
    left = pd.DataFrame({MICROS: events[MICROS].to_numpy(), "code": code})
    right = pd.DataFrame({MICROS: versions[MICROS].to_numpy(), "code": users, "at": np.arange(len(versions))})
    found = pd.merge_asof(left, right, on=MICROS, by="code")["at"].to_numpy(dtype=float, na_value=-1)
    return found.astype(int)


def picked(versions: pd.DataFrame, at: np.ndarray) -> pd.DataFrame:
    """Profiles of the versions ``at``, None for -1."""
    if not len(versions):
        return pd.DataFrame({c: [None] * len(at) for c in PROFILE_COLS}, dtype=object)
    out = versions[PROFILE_COLS].take(np.maximum(at, 0)).reset_index(drop=True).astype(object)
    out.loc[at < 0] = None
    return texts(out)


class Latest:
    """The latest version up to the event's time."""

    extra: list[str] = []

    def versions(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Versions as they are looked up, by time; of several at one time the greatest comes last."""
        return rows.sort_values([MICROS, *PROFILE_COLS], ignore_index=True, na_position="first")

    def stale(self, rows: pd.DataFrame, passed: int) -> pd.DataFrame:
        """The versions that later events can still see, of those that :meth:`versions` gave."""
        old = rows[MICROS].to_numpy() <= passed
        return rows[~old | ~rows[old].duplicated(USER, keep="last").reindex(rows.index, fill_value=True)]

    def answer(self, events: pd.DataFrame, versions: pd.DataFrame, memory: pd.DataFrame, passed: int):
        """(events with profile columns, memory, next time to act at or None)."""
        found = picked(versions, version_of(events, versions))
        return pd.concat([events.reset_index(drop=True), found], axis=1), memory, None


class Maxima(Latest):
    """Each profile column's maximum over all versions up to the event's time, columns on their own."""

    def versions(self, rows):
        rows = super().versions(rows)
        for c in PROFILE_COLS:
            known = rows[c].notna()
            names, codes = np.unique(rows.loc[known, c].to_numpy(dtype=str), return_inverse=True)
            code = pd.Series(-1, index=rows.index)
            code[known] = codes
            top = code.groupby(rows[USER]).cummax().to_numpy(dtype=int)
            rows[c] = [names[i] if i >= 0 else None for i in top]
        return rows


class Kept(Latest):
    """A cache entry per user: taken at the first event that finds none, good for ``ttl`` microseconds, then
    cleared. An event is a ``hit`` if an entry is there; else its user's latest version becomes
    the entry (``fetch``); without a version it is a ``miss``, which is not kept. The clearing of an entry
    is a row ``expired`` of its own, at fetch time + ttl, with user and profile alone."""

    extra = ["cache"]

    def __init__(self, ttl: int):
        self.ttl = ttl

    def answer(self, events, versions, memory, passed):
        events = events.sort_values([USER, MICROS, *[c for c in events if c not in (USER, MICROS)]],
                                    ignore_index=True)
        order = np.argsort(events[MICROS].to_numpy(), kind="stable")
        at = np.empty(len(events), int)
        at[order] = version_of(events.iloc[order], versions)
        candidates = picked(versions, at).to_numpy(dtype=object)
        times = events[MICROS].to_numpy()
        entries = {r[0]: r for r in memory[[USER, MICROS, *PROFILE_COLS]].itertuples(index=False, name=None)}
        profile = np.full((len(events), len(PROFILE_COLS)), None, dtype=object)
        cache, cleared = np.full(len(events), "miss", dtype=object), []
        edges = np.flatnonzero(np.r_[True, events[USER].to_numpy()[1:] != events[USER].to_numpy()[:-1], True]
                               ) if len(events) else [0]
        for low, high in zip(edges[:-1], edges[1:]):
            user = events[USER].iat[low]
            i, entry = low, entries.pop(user, None)
            while i < high:
                if entry is not None:
                    until = low + int(np.searchsorted(times[low:high], entry[1] + self.ttl))
                    profile[i:until], cache[i:until] = entry[2:], "hit"
                    i = until
                    if i < high:
                        cleared.append(entry)
                        entry = None
                elif at[i] >= 0:
                    entry = (user, int(times[i]), *candidates[i])
                    profile[i], cache[i] = entry[2:], "fetch"
                    i += 1
                else:
                    i += 1
            if entry is not None:
                entries[user] = entry
        due = [e for e in entries.values() if e[1] + self.ttl <= passed]
        left = [e for e in entries.values() if e[1] + self.ttl > passed]
        out = events.copy()
        out[PROFILE_COLS], out["cache"] = profile, cache
        gone = pd.DataFrame(cleared + due, columns=[USER, MICROS, *PROFILE_COLS])
        gone[MICROS] = gone[MICROS].astype("int64") + self.ttl
        gone["cache"] = "expired"
        memory = pd.DataFrame(left, columns=[USER, MICROS, *PROFILE_COLS])
        soonest = min((e[1] for e in left), default=None)
        return (pd.concat([out, gone.reindex(columns=out.columns)], ignore_index=True), memory,
                None if soonest is None else soonest + self.ttl)


class Cells(StatefulProcessor):
    """Events wait in their cell until the watermark has passed them, then ``rule`` answers them."""

    def __init__(self, rule: Latest, event_cols: list[str]):
        self.rule, self.event_cols = rule, event_cols
        self.held = [MICROS, *event_cols]
        self.known = [MICROS, USER, *PROFILE_COLS]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "data binary")
        self.updates = handle.getListState("updates", "data binary")
        self.memory = handle.getValueState("memory", "data binary")
        self.timer = handle.getValueState("timer", "millis bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = texts(initialState[[USER, *PROFILE_COLS]])
        rows.insert(0, MICROS, np.int64(ALWAYS))
        self.updates.appendValue((packed(rows),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        first = None
        for chunk in rows:
            micros, is_update = micros_of(chunk[TIME]), chunk[KIND].to_numpy() == UPDATE
            for state, cols, mine in ((self.updates, self.known, is_update), (self.waiting, self.held, ~is_update)):
                if mine.any():
                    part = texts(chunk.loc[mine, cols[1:]])
                    part.insert(0, MICROS, micros[mine])
                    state.appendValue((packed(part),))
            if not is_update.all():
                low = int(micros[~is_update].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        return iter([])

    def _wake(self, micros: int) -> None:
        """Let the cell's only timer stand at ``micros`` or earlier."""
        millis = micros // 1000 + 1
        if self.timer.exists():
            standing = self.timer.get()[0]
            if standing <= millis:
                return
            self.handle.deleteTimer(standing)
        self.handle.registerTimer(millis)
        self.timer.update((millis,))

    @staticmethod
    def _put(state, df: pd.DataFrame) -> None:
        if len(df):
            state.put([(packed(df),)])
        else:
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        waiting = unpacked(self.waiting.get() if self.waiting.exists() else [], self.held)
        versions = self.rule.versions(unpacked(self.updates.get() if self.updates.exists() else [], self.known))
        memory = unpacked([self.memory.get()] if self.memory.exists() else [], self.known)
        ready = waiting[MICROS] <= passed
        done = waiting[ready].sort_values(MICROS, kind="stable", ignore_index=True)
        left = waiting[~ready]
        out, memory, soonest = self.rule.answer(done, versions, memory, passed)
        self._put(self.waiting, left)
        self._put(self.updates, self.rule.stale(versions, passed))
        if len(memory):
            self.memory.update((packed(memory),))
        else:
            self.memory.clear()
        times = [t for t in (soonest, int(left[MICROS].min()) if len(left) else None) if t is not None]
        if times:
            self._wake(min(times))
        cols = [*self.event_cols, *PROFILE_COLS, *self.rule.extra]
        for i in range(0, len(out), 10_000):
            part = out.iloc[i:i + 10_000]
            rows = texts(part[cols])
            rows[TIME] = pd.to_datetime(part[MICROS], unit="us")
            yield rows


def look_up(events: DataFrame, updates: DataFrame, snapshot: DataFrame | None, rule: Latest, delay: str,
            parts: int, cells: int) -> DataFrame:
    """Events with the profile (and ``rule.extra``) columns; ``event_time`` carries the watermark on."""
    # All event columns wait as text: pandas would turn a number column with gaps into floats.
    kinds = {f.name: f.dataType for f in events.schema.fields}
    times = [c for c, kind in kinds.items() if isinstance(kind, T.TimestampType)]
    as_text = lambda c: (F.unix_micros(c) if c in times else F.col(c)).cast("string").alias(c)
    back = lambda c: (F.timestamp_micros(F.col(c).cast("bigint")) if c in times
                      else F.col(c).cast(kinds[c])).alias(c)
    cell = (F.pmod(F.xxhash64(F.col(USER).cast("string")), F.lit(cells)) * parts).cast("int")
    each = F.explode(F.sequence(cell, cell + (parts - 1))).alias(CELL)
    nothing = {c: F.lit(None).cast("string").alias(c) for c in PROFILE_COLS}
    mine = F.pmod(F.xxhash64(*events.columns), F.lit(parts)).cast("int")
    ev = events.withColumn(TIME, F.col("event_time")).withWatermark(TIME, delay).select(
        *map(as_text, events.columns), *nothing.values(), F.lit(EVENT).alias(KIND), TIME,
        (cell + mine).alias(CELL))
    blank = [F.lit(None).cast("string").alias(c) for c in events.columns if c != USER]
    up = updates.withColumn(TIME, F.col("timestamp")).withWatermark(TIME, delay).select(
        USER, *blank, *PROFILE_COLS, F.lit(UPDATE).alias(KIND), TIME, each)
    initial = None
    if snapshot is not None:
        initial = snapshot.select(USER, *PROFILE_COLS, each).groupBy(CELL)
    text = [*events.columns, *PROFILE_COLS, *rule.extra]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in text],
                           T.StructField(TIME, T.TimestampType())])
    found = ev.unionByName(up).groupBy(CELL).transformWithStateInPandas(
        Cells(rule, events.columns), schema, "append", "EventTime", initial, TIME)
    return found.select(*[F.col(TIME).alias(c) if c == "event_time" else back(c) for c in events.columns],
                        *PROFILE_COLS, *rule.extra)


def enrich_hybrid_stream(events: DataFrame, updates: DataFrame, snapshot: DataFrame | None = None,
                         parts: int = 4, delay: str = "1 minute", cells: int = CELLS) -> DataFrame:
    """Events with the latest profile update as of their time, else the snapshot's profile.

    An event is put out once the watermark (``delay`` behind the newest rows of the slower side) has
    passed it. Rows behind the watermark are late and dropped.
    """
    base = None if snapshot is None else latest_profiles(snapshot)
    return look_up(events, updates, base, Latest(), delay, parts, cells)


def enrich_sql_stream(events: DataFrame, updates: DataFrame, snapshot: DataFrame | None = None,
                      dedup: str = "colwise_max", parts: int = 4, delay: str = "1 minute",
                      cells: int = CELLS) -> DataFrame:
    """Events with one profile per user, reduced from the snapshot and the live updates up to their time:
    the maximum of each column (``colwise_max``) or the latest version (``latest``)."""
    if dedup == "colwise_max":
        base = None if snapshot is None else colwise_max(snapshot.select(USER, *PROFILE_COLS), [USER])
        return look_up(events, updates, base, Maxima(), delay, parts, cells)
    if dedup == "latest":
        return enrich_hybrid_stream(events, updates, snapshot, parts, delay, cells)
    raise ValueError(f"dedup must be 'colwise_max' or 'latest', got {dedup!r}")


def enrich_expiring_stream(events: DataFrame, updates: DataFrame, ttl_ms: int,
                           snapshot: DataFrame | None = None, parts: int = 1, delay: str = "1 minute",
                           cells: int = CELLS) -> DataFrame:
    """Events with the profile that a cache holds for their user, and ``cache``, what the cache did.

    The clock is the event time. An entry is fetched (the latest version at that time) when an
    event finds none and cleared by a timer at fetch time + ``ttl_ms``, see :class:`Kept`; versions that arrive
    meanwhile are not seen. ``expired`` rows have an event time and a user, but no other event columns.
    With ``parts`` a hot user has that many entries.
    """
    base = None if snapshot is None else latest_profiles(snapshot)
    return look_up(events, updates, base, Kept(ttl_ms * 1000), delay, parts, cells)
