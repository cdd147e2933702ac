"""Topics as DataFrames with the message envelope of ``schemas.ENVELOPE``.

The broker path needs the public Kafka connector package on the class path. The replay path reads
stored messages with the same columns, so all other code is the same for both.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork import schemas as S
from rillwork.functions import millis_to_time

REPLAY_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def starting_offsets(position: str | None) -> str:
    """``earliest`` in any case means earliest; everything else means latest."""
    return "earliest" if (position or "").lower() == "earliest" else "latest"


def _options(servers: str, topics: str | list[str], starting: str | None, group_id: str | None,
             extra: dict[str, str] | None) -> dict[str, str]:
    names = [topics] if isinstance(topics, str) else list(topics)
    opts = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(names),
            "startingOffsets": starting_offsets(starting)}
    if group_id:
        # A prefix: each query makes its own id from it. Queries that shared one id would share the
        # topic's partitions, and each read only part of the messages.
        opts["groupIdPrefix"] = group_id
    return {**opts, **(extra or {})}


def envelope(raw: DataFrame) -> DataFrame:
    """Keys and values as text, columns in envelope order."""
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.ENVELOPE.fields])


def topic_stream(spark: SparkSession, servers: str, topic: str | list[str],
                 starting: str | None = "latest", group_id: str | None = None,
                 **extra: str) -> DataFrame:
    """One topic (or several) as a stream.

    The start position counts on the first start only; afterwards the checkpoint decides. Pass
    ``maxOffsetsPerTrigger`` to bound a micro-batch.
    """
    opts = _options(servers, topic, starting, group_id, extra)
    return envelope(spark.readStream.format("kafka").options(**opts).load())


def topic_batch(spark: SparkSession, servers: str, topics: str | list[str],
                from_beginning: bool = True, offsets: dict | None = None, **extra: str
                ) -> DataFrame:
    """A bounded read of topics. ``offsets`` ({topic: {partition: offset}}) starts elsewhere."""
    opts = _options(servers, topics, "earliest", None, extra)
    if offsets is not None:
        opts["startingOffsets"] = json.dumps(offsets)
    elif not from_beginning:
        raise ValueError("a batch read needs 'offsets' when it does not start at the beginning")
    return envelope(spark.read.format("kafka").options(**opts).load())


def _replay(reader, path: str, fmt: str, options: dict[str, str]) -> DataFrame:
    if fmt not in REPLAY_FORMATS:
        raise ValueError(f"format must be one of {REPLAY_FORMATS}, got {fmt!r}")
    return reader.format(fmt).schema(S.ENVELOPE).options(**options).load(path)


def replay_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options: str
                  ) -> DataFrame:
    """Stored messages as a stream; ``maxFilesPerTrigger`` bounds a micro-batch."""
    return _replay(spark.readStream, path, fmt, options)


def replay_batch(spark: SparkSession, path: str, fmt: str = "parquet", **options: str
                 ) -> DataFrame:
    return _replay(spark.read, path, fmt, options)


def from_epoch_millis(df: DataFrame, millis_col: str = "timestamp") -> DataFrame:
    """Envelope time given as epoch milliseconds to a timestamp."""
    return df.withColumn(millis_col, millis_to_time(F.col(millis_col)))
