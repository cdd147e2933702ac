"""Small bounded reads: newest rows of a table, first messages of a topic."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillwork.sources import files

# Python workers get this module's code with the task; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

@F.pandas_udf(T.StringType())
def _indented(values: pd.Series) -> pd.Series:
    """For display only, applied to the few chosen messages. Text that is no JSON stays as it is."""

    def one(text):
        try:
            return json.dumps(json.loads(text), indent=2)
        except (TypeError, ValueError):
            return text

    return values.map(one)


def newest(df: DataFrame, order_col: str, n: int = 10, ties: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` newest rows; ``ties`` makes the choice deterministic."""
    return df.orderBy(F.col(order_col).desc(), *ties).limit(n)


def newest_by_day(spark: SparkSession, path: str, day_col: str, order_col: str, n: int = 10,
                  ties: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` newest rows of a table that is partitioned by the day of ``order_col``; older days are not read.

    Days are taken newest first, twice as many each time, until they hold ``n`` rows: all rows of the days left out
    are older than those, so ties never cross. Counting rows reads file footers only. Rows without a
    day (null time) come last.
    """
    days = [d for d in files.names(spark, path) if d.startswith(f"{day_col}=")]
    dated = sorted((d for d in days if not d.endswith("__HIVE_DEFAULT_PARTITION__")), reverse=True)
    order = dated + [d for d in days if d not in dated]
    take = 1
    while True:
        chosen = [f"{path.rstrip('/')}/{d}" for d in order[:take]]
        df = spark.read.option("basePath", path).parquet(*(chosen or [path]))
        if take >= len(order) or df.count() >= n:
            return newest(df, order_col, n, ties)
        take *= 2


def select_topics(messages: DataFrame, topics: list[str] | None = None) -> DataFrame:
    return messages if topics is None else messages.where(F.col("topic").isin(topics))


def peek(messages: DataFrame, n: int, topics: list[str] | None = None,
         from_beginning: bool = True, pretty: bool = True) -> DataFrame:
    """``n`` messages with their envelope, oldest first or newest first."""
    chosen = select_topics(messages, topics)
    order = ["timestamp", "topic", "partition", "offset"]
    cols = [F.col(c).asc() if from_beginning else F.col(c).desc() for c in order]
    first = chosen.orderBy(*cols).limit(n)
    if not pretty:
        return first
    return first.withColumn("value", _indented("value"))
