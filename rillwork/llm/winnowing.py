"""Document fingerprints by winnowing.

A text's characters, white space left out and A-Z lower-cased, are hashed in runs of ``GRAM`` by a rolling
polynomial. From every ``WINDOW`` consecutive hashes the smallest is kept, of equal ones the rightmost, with the
position of its run. So any two texts that share GRAM + WINDOW - 1 such characters in a row share a
kept hash (the guarantee), nothing shorter than GRAM can match, and about 2 / (WINDOW + 1) of all hashes are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rillwork.llm.common import arrow_map, quoted

#: Characters of a run, and hashes of a window: texts that share GRAM + WINDOW - 1 characters are found.
GRAM, WINDOW = 24, 32
#: Characters that a task of :func:`with_next` works through, about.
TASK_CHARS = 16_000_000
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of each run of ``size`` codes, by doubling: a run is two shorter ones."""
    with np.errstate(over="ignore"):
        power, step, total, done = BASE, codes, None, 0
        width = 1
        while True:
            if size & width:
                # Runs of ``done`` codes before, then one of ``width``.
                total = step if total is None else total[:len(total) - width] * power + step[done:]
                done += width
            if done == size:
                return total
            step = step[:-width] * power + step[width:]
            width, power = width * 2, power * power


def grams(codes: np.ndarray) -> np.ndarray:
    """A well-mixed hash of each run of GRAM codes; of the whole text if it is shorter."""
    if not len(codes):
        return np.empty(0, np.uint64)
    values = rolled(codes + np.uint64(1), min(GRAM, len(codes)))
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def smallest(values: np.ndarray) -> np.ndarray:
    """Indexes of the kept hashes: each window's smallest, of equal ones the rightmost."""
    if len(values) == 0:
        return np.empty(0, np.int64)
    best, size, width = np.arange(len(values)), 1, min(WINDOW, len(values))
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        size += step
    return best[np.r_[True, np.diff(best) != 0]]


def winnow(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions of their runs in code points) in the order of the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    seen = np.flatnonzero((codes != 0x20) & ((codes < 0x09) | (codes > 0x0D)))
    plain = codes[seen]
    plain = np.where((plain >= 0x41) & (plain <= 0x5A), plain + 0x20, plain).astype(np.uint64)
    values = grams(plain)
    kept = smallest(values)
    return values[kept], seen[kept]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of either that both hold; two texts without any are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash@position`` of each kept hash, by position."""
    return ",".join([f"{h:016x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def fingerprints(df: DataFrame, text_col: str = "text", to: str = "fingerprint") -> DataFrame:
    """The frame with an array of (hash, position) for each row, in the order of the text; a column of that
    name is replaced. Null, empty and blank texts have none; a text under GRAM characters has one."""
    def run(texts):
        kept = [winnow(t or "") for t in texts]
        return pa.array([[{"hash": h, "position": p} for h, p in zip(
            hashes.view(np.int64).tolist(), at.tolist())] for hashes, at in kept],
            pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())])))

    return df.withColumn(to, arrow_map(run, "array<struct<hash:bigint,position:bigint>>")(quoted(text_col)))


# Documents beside the next one ------------------------------------------------------------------------

OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """The rows of (doc_id, text) with the number of their id range, and how many ranges there are: ids are
    cut at quantiles into ranges of about TASK_CHARS characters. Rows without id are behind all others."""
    spark = docs.sparkSession
    chars, rows = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    n = int(max(1, min(rows, max(chars // TASK_CHARS, spark.sparkContext.defaultParallelism))))
    shares = [i / n for i in range(1, n)]
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 100 * n)).first()[0] if (
        shares) else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    def place(ids):
        return pa.array(np.where([i is None for i in ids], len(cuts),
                                 np.searchsorted(cuts, [i or 0 for i in ids], side="right")), pa.int32())

    return docs.withColumn("part", arrow_map(place, "int")("doc_id")), len(cuts) + 1


def with_next(docs: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` (an iterator of (doc_id, text, text of the next document) -> record batches) over all rows of
    (doc_id, text) by ascending id, equal ids by text; after the last row comes the first.

    Texts are shuffled once, to the task of their range, where they are sorted (and spilled if need be) and
    walked in order. The first document of a range closes the range before; these are one row a range.
    """
    placed, n = in_ranges(docs)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text")
    firsts = placed.groupBy("part").agg(F.min(row).alias("row"))
    heads = sorted(r["part"] for r in firsts.select("part").collect())  # at most one number a range
    before = {p: heads[i - 1] for i, p in enumerate(heads)}
    moved = spark_map(before)
    closing = firsts.select("row.doc_id", "row.text", moved(F.col("part")).alias("part"), F.lit(1).alias("closes"))
    rows = placed.select("doc_id", "text", "part", F.lit(0).alias("closes")).unionByName(closing)
    dealt = rows.repartitionById(n, F.col("part")).sortWithinPartitions(
        "part", "closes", F.col("doc_id").isNull(), "doc_id", "text")

    def run(batches):
        def pairs():
            held = None
            for batch in batches:
                cols = [c.to_pylist() for c in batch.columns]
                for doc_id, text, part, closes in zip(*cols):
                    if held is not None:
                        yield *held, text or ""
                    held = None if closes else (doc_id, text or "")

        yield from fn(pairs())

    return dealt.select("doc_id", "text", "part", "closes").mapInArrow(run, schema)


def spark_map(numbers: dict[int, int]):
    """A column function that looks a number up."""
    return lambda col: arrow_map(lambda ks: pa.array([numbers[k] for k in ks], pa.int32()), "int")(col)


def edited(text: str, following: str) -> str:
    """The last quarter of a text (rounded down) replaced by as many first characters of the other text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_rows(rows):
    """Rows of OUT; the fingerprint of the next document is the one made when it is met as such."""
    def batch(out):
        return pa.RecordBatch.from_pylist(out, pa.schema(
            [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
             ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
             ("near_edited", pa.float64()), ("near_next", pa.float64())]))

    out, known = [], None
    for doc_id, text, following in rows:
        own = known[1] if known is not None and known[0] == text else winnow(text)
        changed, after = edited(text, following), winnow(following)
        other = winnow(changed)
        known = (following, after)
        out.append({"doc_id": doc_id, "n_chars": len(text),
                    "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                    "fingerprint": as_text(*own), "edited_fingerprint": as_text(*other),
                    "near_edited": likeness(own[0], other[0]), "near_next": likeness(own[0], after[0])})
        if len(out) == 256:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the document with its last quarter (rounded down) replaced by the first characters of the next
    document, by ascending id; after the last comes the first. Null texts are empty. Rows with equal ids
    follow one another by text, rows without id come last; all rows come back. Empty texts have an empty
    fingerprint; two of them are alike (1), an empty one and another are not (0).
    """
    docs = df.select(quoted(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    return with_next(docs, compare_rows, OUT)
