"""Queries kept as text files, run against named inputs."""

from __future__ import annotations

from pathlib import Path
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

SQL_DIR = Path(__file__).resolve().parent.parent / "sql"

#: Held while view names stand for one caller's inputs.
_NAMES = Lock()


def read_query(path: str | Path) -> str:
    """Text of a query file; a bare name is looked up among the bundled queries."""
    found = Path(path)
    if not found.exists():
        found = SQL_DIR / str(path)
    if not found.is_file():
        raise FileNotFoundError(f"no query file {path}")
    return found.read_text()


def run_sql_file(spark: SparkSession, path: str | Path, inputs: dict[str, DataFrame],
                 **params: str) -> DataFrame:
    """Register ``inputs`` as temp views and run the query. ``params`` fill ``:name`` markers.

    Names are resolved before this returns, and callers in several threads take turns: each result
    reads its own inputs, whatever the names stand for later.
    """
    text = read_query(path)
    with _NAMES:
        for name, df in inputs.items():
            df.createOrReplaceTempView(name)
        found = spark.sql(text, args=params or None)
        found.schema  # the analysed plan
        return found


def run_single_input(spark: SparkSession, path: str | Path, df: DataFrame, **params: str
                     ) -> DataFrame:
    """The one-input form: the query reads from PCOLLECTION."""
    return run_sql_file(spark, path, {"PCOLLECTION": df}, **params)
