"""A user's Python function on message texts, one message's failure kept to itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

RESULT = pa.struct([("record", pa.string()), ("error", pa.string())])


class Isolated:
    """``fn`` (text -> record text) as a column function that gives (record, error) per message.

    Messages travel in Arrow batches. An exception becomes the message's error, as does a result that is no
    text; the others go on. Null messages are not handed over. ``files`` (modules the function imports) are
    sent to all executors.
    """

    def __init__(self, fn: Callable[[str], str], files: list[str | Path] = ()):
        self.fn, self.files = fn, [str(f) for f in files]

    def ship(self, spark: SparkSession) -> None:
        for f in self.files:
            spark.addArtifact(f, pyfile=True)

    def __call__(self, value: Column) -> Column:
        fn = self.fn

        def one(text):
            if text is None:
                return None, None
            try:
                record = fn(text)
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"
            if not isinstance(record, str):
                return None, f"TypeError: result is {type(record).__name__}, not text"
            return record, None

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                done = [one(t) for t in batch.to_pylist()]
                yield pa.StructArray.from_arrays(
                    [pa.array([r for r, _ in done], pa.string()), pa.array([e for _, e in done], pa.string())],
                    fields=list(RESULT))

        # Not deterministic as far as the optimizer knows: a filter must not run it a second time.
        return F.arrow_udf(run, "record string, error string").asNondeterministic()(value)
