"""Stored tables: bounded scans and typed profile rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork.functions import parse_time
from rillwork.operators.parse import ERROR, PROFILE_FIELDS, Parsed


def table_scan(spark: SparkSession, name_or_path: str, fmt: str | None = None, **options: str
               ) -> DataFrame:
    """A catalog table, or with a path (or ``fmt``) a file or connector read."""
    if fmt is None and "/" not in name_or_path:
        return spark.read.table(name_or_path)
    return spark.read.format(fmt or "parquet").options(**options).load(name_or_path)


def to_profile_rows(table: DataFrame, on_bad_ts: str = "reject") -> Parsed:
    """Table rows to in-flight profile rows, and the rows whose timestamp is none.

    Accepts typed timestamps and text (``... UTC`` or ISO-8601). Text that is no timestamp sends its
    row to the rejects, or counts as the current time with ``on_bad_ts='now'``.
    """
    typed = dict(table.dtypes)["timestamp"].startswith("timestamp")
    time = F.col("timestamp").cast("timestamp") if typed else parse_time(F.col("timestamp"))
    if on_bad_ts not in ("reject", "now"):
        raise ValueError(f"on_bad_ts must be 'reject' or 'now', got {on_bad_ts!r}")
    bad = time.isNull() if on_bad_ts == "reject" else F.lit(False)
    read = F.coalesce(time, F.current_timestamp()) if on_bad_ts == "now" else time
    rows = table.where(~bad).select(*[F.col(c).cast("string").alias(c) for c in PROFILE_FIELDS],
                                    read.alias("timestamp"))
    error = F.lit("missing or invalid: timestamp").alias(ERROR)
    return Parsed(rows, table.where(bad).select(*table.columns, error))
