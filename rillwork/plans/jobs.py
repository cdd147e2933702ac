"""The three jobs, as option objects that start one streaming query per output.

Outputs whose options are not set are not built. ``open_topic`` replaces the broker, for example by
a replay of stored messages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillwork import schemas as S
from rillwork.operators import aggregate as agg, join as jn, parse as ps
from rillwork.session import apply_defaults
from rillwork.sources import tables, topics
from rillwork.streaming import commits, sinks
from rillwork.streaming.lookups import RefreshingLookup

OpenTopic = Callable[[SparkSession, str], DataFrame]
Lookup = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class _TopicJob:
    bootstrap_servers: str = ""
    consumer_group_id: str | None = None
    kafka_read_offset: str | None = None
    checkpoint: str = ""
    quarantine: str | None = None  # without one a bad message ends its query
    trigger: dict | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    open_topic: OpenTopic | None = None

    def _topic(self, spark: SparkSession, topic: str) -> DataFrame:
        if self.open_topic is not None:
            return self.open_topic(spark, topic)
        return topics.topic_stream(spark, self.bootstrap_servers, topic, self.kafka_read_offset,
                                   self.consumer_group_id, **self.source_options)

    @property
    def mode(self) -> str:
        return "fail" if self.quarantine is None else "quarantine"

    def _append(self, df: DataFrame, target: str, schema, table: str) -> StreamingQuery:
        return sinks.append(df, target, schema, f"{self.checkpoint}/{table}",
                            S.PARTITION_BY.get(table), self.trigger, name=table)

    def _rejects_target(self, topic: str) -> str:
        return f"{self.quarantine}/{topic}" if sinks.is_path(self.quarantine) else self.quarantine

    def _rejects(self, rejects: DataFrame, topic: str) -> list[StreamingQuery]:
        if self.quarantine is None:
            return []
        return [sinks.append(rejects, self._rejects_target(topic), None,
                             f"{self.checkpoint}/rejects-{topic}", None, self.trigger,
                             name=f"rejects-{topic}")]


@dataclass(frozen=True)
class BranchedJob(_TopicJob):
    """One topic, up to three tables: flat events, raw payloads, counts per minute."""

    topic: str = ""
    output_table: str = ""
    generic_output_table: str | None = None
    aggregation_table: str | None = None
    width: str = "1 minute"
    delay: str = "1 minute"
    one_scan: bool = True
    commit_root: str | None = None

    def start(self, spark: SparkSession) -> list[StreamingQuery]:
        """The first two tables and the rejects share a single read of the topic; without ``one_scan``
        each has a query of its own. Counts are always a query of their own. With ``commit_root`` tables
        and rejects are names below that folder and every micro-batch is one commit of all of them."""
        messages = self._topic(apply_defaults(spark), self.topic)
        mode, running = self.mode, []
        if self.one_scan:
            branches = [sinks.Branch(lambda df: ps.flatten_events(df, mode), self.output_table,
                                     S.USER_EVENTS)]
            if self.generic_output_table:
                branches.append(sinks.Branch(lambda df: ps.generic_events(df, mode),
                                             self.generic_output_table, S.GENERIC,
                                             S.PARTITION_BY["generic"]))
            if self.quarantine:
                branches.append(sinks.Branch(
                    lambda df: ps.parse_events(df).rejects,
                    self.quarantine if self.commit_root else self._rejects_target(self.topic)))
            checkpoint = f"{self.checkpoint}/tables"
            running.append(
                commits.write_together(messages, branches, self.commit_root, checkpoint, self.trigger, "tables")
                if self.commit_root else
                sinks.write_all(messages, branches, checkpoint, self.trigger, "tables"))
        else:
            running.append(self._append(ps.flatten_events(messages, mode), self.output_table,
                                        S.USER_EVENTS, "user_events"))
            if self.generic_output_table:
                running.append(self._append(ps.generic_events(messages, mode),
                                            self.generic_output_table, S.GENERIC, "generic"))
            running += self._rejects(ps.parse_events(messages).rejects, self.topic)
        if self.aggregation_table:
            rows = ps.parse_events(messages, mode).rows
            counts = agg.count_by_window(rows, width=self.width, delay=self.delay)
            running.append(self._append(agg.aggregation_records(counts), self.aggregation_table,
                                        S.EVENT_COUNTS, "user_event_aggregations"))
        return running


@dataclass(frozen=True)
class MultiTopicJob(_TopicJob):
    """Profiles to a table; events joined with product updates and enriched with profiles."""

    user_events_topic: str | None = None
    user_profiles_topic: str | None = None
    product_updates_topic: str | None = None
    user_profiles_table: str | None = None
    enriched_events_table: str | None = None
    width: str = "1 minute"
    delay: str = "1 minute"
    spread: int = 4
    refresh_seconds: float | None = None
    lookup: Lookup | None = None

    def start(self, spark: SparkSession) -> list[StreamingQuery]:
        """Profiles are read once, when enrichment starts. ``refresh_seconds`` renews them while
        the job runs. ``lookup`` (any object of ``streaming.lookups``) takes their place: it is called
        with each micro-batch. Profiles that are never renewed meet the events before the window join, which may
        give many rows per event."""
        spark = apply_defaults(spark)
        mode, running = self.mode, []
        if self.user_profiles_table and self.user_profiles_topic:
            parsed = ps.parse_profile_records(self._topic(spark, self.user_profiles_topic), mode)
            running.append(self._append(parsed.rows, self.user_profiles_table, S.USER_PROFILES,
                                        "user_profiles"))
            running += self._rejects(parsed.rejects, self.user_profiles_topic)
        if (self.enriched_events_table and self.user_events_topic and self.product_updates_topic
                and self.user_profiles_topic):
            events = ps.parse_events(self._topic(spark, self.user_events_topic), mode)
            products = ps.parse_products(self._topic(spark, self.product_updates_topic), mode)
            load = lambda: tables.to_profile_rows(
                tables.table_scan(spark, self.user_profiles_table)).rows
            lookup = self.lookup or RefreshingLookup(load, self.refresh_seconds)
            join = lambda rows, keep: jn.join_in_window(rows, products.rows, self.width, self.delay,
                                                        spread=self.spread, keep=keep)
            if isinstance(lookup, RefreshingLookup) and lookup.every is None:
                known = jn.join_profiles(events.rows, lookup.dimension(), self.spread)
                running.append(self._append(jn.enriched_records(join(known, jn.PROFILE_COLS)),
                                            self.enriched_events_table, S.ENRICHED_EVENTS, "enriched_events"))
            else:
                running.append(sinks.write_each(
                    join(events.rows, ()), lambda df, i: jn.enriched_records(lookup(df, i)),
                    self.enriched_events_table, f"{self.checkpoint}/enriched_events",
                    S.ENRICHED_EVENTS, S.PARTITION_BY["enriched_events"], self.trigger,
                    "enriched_events"))
            running += self._rejects(events.rejects, self.user_events_topic)
            running += self._rejects(products.rejects, self.product_updates_topic)
        return running


@dataclass(frozen=True)
class TemplateJob(_TopicJob):
    """One topic through a user function (text to record text) into the generic table."""

    topic: str = ""
    output_table: str = ""
    transform: Callable[[Column], Column] | None = None
    kafka_read_offset: str | None = "earliest"

    def start(self, spark: SparkSession) -> list[StreamingQuery]:
        messages = self._topic(apply_defaults(spark), self.topic)
        done = ps.parse_payload(messages, self.transform, self.mode)
        return [self._append(done.rows, self.output_table, S.GENERIC, "generic"),
                *self._rejects(done.rejects, self.topic)]


def wait(running: list[StreamingQuery]) -> None:
    """Block until every query ends; the first failure is raised."""
    for q in running:
        q.awaitTermination()
