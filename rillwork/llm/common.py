"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillwork.session import apply_defaults, shared_dir

#: ASCII white space that separates words, and what is left: a word.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: Rows that an operator works on at once, so that its lists stay small, and rows of an Arrow batch.
SLICE, BATCH = 64, 512


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on. Texts are long: small Arrow batches keep
    executors and Python workers within little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return apply_defaults(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the folder that the cluster shares. Later jobs read the
    table: neither a lost executor nor a second reader makes the work be done again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrow_map(fn: Callable[..., pa.Array], returns: str) -> Callable[..., Column]:
    """A column function from ``fn`` (a list of values per column -> Arrow array), called on slices.

    Marked non-deterministic only so that the optimizer neither copies it into filters nor evaluates
    it twice; results depend on the values alone.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            cols = batch if isinstance(batch, tuple) else (batch,)
            yield pa.concat_arrays([fn(*(c.slice(i, SLICE).to_pylist() for c in cols))
                                    for i in range(0, max(len(cols[0]), 1), SLICE)])

    return F.arrow_udf(run, returns).asNondeterministic()


def least_by_hash(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """At most ``n`` of the ``total`` rows, those with the least hashes of ``key``. Hashes above a limit that
    leaves about ``n`` rows are filtered first, so that all tasks together sort that many, not each of them."""
    share = min(1.0, (n + 8 * n ** 0.5 + 64) / max(total, 1))
    limit = min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63)
    return df.where(F.xxhash64(key) <= limit).orderBy(F.xxhash64(key), key).limit(n)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a form of it that no column of the frame has (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots and back ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
