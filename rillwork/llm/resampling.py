"""Target-distribution importance resampling over hashed word runs.

Features of a text are its runs of one to three words, hashed into ``BUCKETS`` buckets. A bucket's gain is the
log ratio of its smoothed frequencies in target and corpus, a document's weight the sum of its
features' gains. Gumbel noise from the document's id turns weights into keys whose highest ones are a draw
without replacement in proportion to exp(weight).

The ranks of the draw come from a distributed least-significant-digit radix sort over the composite key (score
descending, id ascending). A pass counts digits per part, turns the counts into global prefix offsets (all
smaller digits, then the same digit in earlier parts) and gives each row its destination: the offset plus its
place among the part's rows with that digit, in the order they lie in. The destination is the row's position for the
next pass, and its rank after the last. Passes over digits in which all keys agree are left out.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillwork.llm.common import free_name, quoted, written
from rillwork.llm.terms import terms_of

BUCKETS, RUN = 10_000, 3
#: Documents under so many words are not drawn; per cent of the others that are.
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
#: Bits of a digit, and rows of a part.
DIGIT, PART = 12, 1 << 20
#: Words longer than this are moved over in steps of it.
LONGEST = 64


# Hashed features ------------------------------------------------------------------------------------------

def zero_steps() -> np.ndarray:
    """(LONGEST + 1, 4, 256): what each byte of a checksum becomes when so many bytes follow.

    Checksums are linear: crc(a + b) = crc(a) moved over len(b) bytes ^ crc(b).
    """
    one = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint32)
    byte = one ^ one[0]  # the plain table: checksums of one byte without start and end values
    out = np.zeros((LONGEST + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, LONGEST + 1):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ byte[out[n - 1] & np.uint32(0xFF)]
    return out


def moved(crc: np.ndarray, sizes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Checksums moved over ``sizes`` bytes."""
    while True:
        now = np.minimum(sizes, LONGEST)
        crc = (steps[now, 0, crc & 0xFF] ^ steps[now, 1, (crc >> 8) & 0xFF]
               ^ steps[now, 2, (crc >> 16) & 0xFF] ^ steps[now, 3, crc >> 24])
        sizes = sizes - now
        if not sizes.any():
            return crc


class Features:
    """Buckets of the features of texts, in arrays; one per task."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.steps, self.space = buckets, zero_steps(), np.uint32(zlib.crc32(b" "))

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of each run)."""
        words = terms_of(text)
        if not words:
            return 0, np.empty(0, np.int64)
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        runs, last = [crc], crc
        for n in range(1, min(RUN, len(words))):
            # A run of n words, a space, one word more.
            before = moved(last[:-1], np.ones(1, np.int64), self.steps) ^ self.space
            last = moved(before, size[n:], self.steps) ^ crc[n:]
            runs.append(last)
        return len(words), np.concatenate(runs).astype(np.int64) % self.buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts of a one-column frame; each task sends one row a bucket."""
    def run(batches):
        features, total = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(features.of(text)[1], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total), pa.int64()),
                                          pa.array(total[total > 0], pa.int64())], ["bucket", "n"])

    return texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed frequencies) of each bucket, from (bucket, n) frames."""
    s, t = [0] * buckets, [0] * buckets
    for counts, frame in ((s, source), (t, target)):
        for r in frame.collect():  # at most one row a bucket
            counts[r["bucket"]] = r["n"]
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
                     for b in range(buckets)], np.int64)


def weigher(gain: np.ndarray):
    """Rows of (key, number of words, number of features, weight) of (key, text)."""
    def run(batches):
        features = Features(len(gain))
        for batch in batches:
            words, n, weight = [], [], []
            for text in batch.column(1).to_pylist():
                count, found = features.of(text)
                words.append(count)
                n.append(len(found))
                weight.append(int(gain[found].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in (words, n, weight)]],
                ["doc_id", "n_words", "n_features", "weight"])

    return run


# Radix sort -----------------------------------------------------------------------------------------------

def sort_key(col: str, descending: bool) -> Column:
    """A bigint whose bits, read without sign, order as the column does."""
    flipped = F.col(col).bitwiseXOR(F.lit(-2 ** 63).cast("bigint"))
    return F.bitwise_not(flipped) if descending else flipped


def radix_ranks(rows: DataFrame, by: list[tuple[str, bool]], to: str, part_rows: int = PART) -> DataFrame:
    """The rows with their rank (from 1) by bigint columns ``by`` (name, descending), most significant first.

    Equal keys rank in the order the rows lie in. No column may be null. Each pass shuffles the rows
    once, to (part, digit); a digit that a third of all rows share is spread over as many tasks as there
    are parts. Each pass is written, so a lost executor repeats one.
    """
    keys = [f"k{i}" for i in range(len(by))]
    held = rows.select(F.struct(*map(quoted, rows.columns)).alias("row"),
                       *[sort_key(c, d).alias(k) for k, (c, d) in zip(keys, by)])
    # First positions: where a row lies in the written table's files; parts are those of the writer.
    at = F.monotonically_increasing_id()
    table = written(held.withColumn("at", at), "keys").withColumn("part", F.shiftright("at", 33))
    differ = table.agg(*[F.bit_or(F.col(k)).alias(f"{k}_or") for k in keys],
                       *[F.bit_and(F.col(k)).alias(f"{k}_and") for k in keys]).first()
    for k in reversed(keys):
        bits = (differ[f"{k}_or"] or 0) ^ (differ[f"{k}_and"] or 0)
        for shift in range(0, 64, DIGIT):
            if (bits >> shift) & ((1 << DIGIT) - 1) & (2 ** 64 - 1 >> shift):
                table = counting_pass(table, k, shift, part_rows)
    if "offset" not in table.columns:  # all keys are equal: the order they lie in
        table = counting_pass(table, keys[0], 0, part_rows)
    return table.select("row.*", (F.col("at") + 1).alias(to))


def counting_pass(table: DataFrame, key: str, shift: int, part_rows: int) -> DataFrame:
    """One stable counting sort by a digit: ``at`` becomes the row's place in the new order."""
    digit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int")
    dealt = table.drop("offset").withColumn("digit", digit)
    counts = written(dealt.groupBy("part", "digit").agg(F.count("*").alias("n")), "digits")
    smaller, total = {}, 0
    for r in sorted(counts.groupBy("digit").agg(F.sum("n").alias("n")).collect()):  # a row a digit
        smaller[r["digit"]] = total
        total += r["n"]
    spark = table.sparkSession
    firsts = spark.createDataFrame(sorted(smaller.items()), "digit int, first bigint")
    earlier = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.join(F.broadcast(firsts), "digit")  # 2 ** DIGIT rows at most
               .select("part", "digit", (F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                       .alias("offset")))
    inside = F.row_number().over(Window.partitionBy("part", "digit").orderBy("at"))
    placed = dealt.withColumn("inside", inside).join(offsets, ["part", "digit"])
    place = (F.col("offset") + F.col("inside") - 1).alias("at")
    keys = [c for c in table.columns if c not in ("part", "at", "offset")]
    moved_to = placed.select(*keys, place, "offset")
    return written(moved_to, "pass").withColumn("part", (F.col("at") / part_rows).cast("bigint"))


# Resampling -----------------------------------------------------------------------------------------------

def noisy(weight: Column, doc_id: Column, seed: int) -> Column:
    """Weight plus Gumbel noise in thousandths; the noise is the id's."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             part_rows: int = PART) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank (null if it is not drawn).

    Drawn are the floor(percent * N / 100) highest scores of the N documents with ``least_words`` words or
    more, ties to the smaller id. Null and empty texts have no features and weight 0. Rows without id have no
    noise: their score is null, and they are neither counted in N nor drawn. Rows with the same id are documents of
    their own. Bucket counts cover all documents and all target texts.
    """
    text = quoted(text_col).alias("text")
    gain = gains(bucket_counts(docs.select(text)), bucket_counts(target.select(quoted(target_col))))
    weights = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), text).mapInArrow(
        weigher(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    weights = written(weights, "weights").withColumn("score", noisy(F.col("weight"), F.col("doc_id"), seed))
    may = F.coalesce((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull(), F.lit(False))
    ranked = radix_ranks(weights.where(may), [("score", True), ("doc_id", False)], "rank", part_rows)
    drawn = weights.where(may).count() * percent // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = weights.where(~may).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", rank).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that :func:`resample` draws, all their columns, ids distinct."""
    rank, its = free_name(docs, "rank"), free_name(docs, "its")
    ranks = resample(docs, target, id_col=id_col, **options).where("rank is not null").select(
        F.col("doc_id").alias(its), F.col("rank").alias(rank))
    return docs.join(ranks, quoted(id_col).cast("bigint") == F.col(its)).drop(its, rank)
