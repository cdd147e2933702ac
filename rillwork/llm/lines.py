"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. The index knows for
each key of at least ``least_chars`` code points how many documents hold it, and the largest id among them.
Keys held by at least ``least_docs`` documents are *frequent*: cleaning drops their lines everywhere but
in the document with the largest id. A cuckoo filter per shard holds the frequent keys; a line that
passes its filter is looked up in the exact table, so false positives cost a lookup and nothing else.

Documents can be inserted and deleted in any order. The index is a folder of Parquet tables; a version counts once
its manifest is there, written last. So an index can be opened again, and what a lost driver left of a batch is
written over:

    changes/NNNNNN   (key, doc_id, sign)            what each batch added (+1) or took away (-1)
    counts/NNNNNN    (key, shard, n_docs, last_doc)  exact reference counts after the batch
    filters/NNNNNN   (shard, filter)                 the filters after the batch
    manifest/NNNNNN  shards and what counts as frequent
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork.llm.common import arrow_map, free_name, quoted, written
from rillwork.llm.cuckoo import CuckooFilter
from rillwork.session import shared_dir
from rillwork.sources import files

SPACE = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Frequent keys of a shard that the number of shards aims at; at twice as many there are more shards.
SHARD_KEYS, LEAST_SHARDS = 50_000, 8
#: Parts that the lines of one shard are spread over when they meet its filter: a line that a third of
#: all documents hold is probed by several tasks.
SPREAD = 16

CHANGES = "key binary, doc_id bigint, sign int"
COUNTS = "key binary, shard int, n_docs bigint, last_doc bigint"
FILTERS = "shard int, filter binary"


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """128-bit digest of a line's key; None if the key is too short."""
    import xxhash
    key = line.strip(SPACE).lower()
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode()) < least_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(text: str | None, least_chars: int) -> set[bytes]:
    found = {line_key(line, least_chars) for line in text.encode().split(b"\n")} if text else set()
    return found - {None}


def clean(text: str | None, dropped: list[bytes] | None, least_chars: int) -> tuple[int, int, str]:
    """(lines, dropped lines, kept text)"""
    lines = text.encode().split(b"\n") if text else [b""]
    if not dropped:
        return len(lines), 0, text or ""
    gone = set(dropped)
    kept = [x for x in lines if line_key(x, least_chars) not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


class LineIndex:
    """Keys of the documents in the index, their reference counts and filters."""

    def __init__(self, spark: SparkSession, folder: str, least_chars: int = LEAST_CHARS,
                 least_docs: int = LEAST_DOCS):
        self.spark, self.folder = spark, folder
        self.least_chars, self.least_docs = least_chars, least_docs
        self.version, self.shards = 0, 0
        found = files.names(spark, f"{folder}/manifest")
        if found:
            made = json.loads(files.text(spark, f"{folder}/manifest/{found[-1]}"))
            if (made["least_chars"], made["least_docs"]) != (least_chars, least_docs):
                raise ValueError(f"the index was made with {made}")
            self.version, self.shards = int(found[-1]), made["shards"]

    # Tables ------------------------------------------------------------------------------------

    def _read(self, table: str, schema: str, version: int | None = None) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], schema)
        versions = [version] if version else range(1, self.version + 1)
        return self.spark.read.schema(schema).parquet(
            *[f"{self.folder}/{table}/{v:06d}" for v in versions])

    def _write(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{table}/{self.version + 1:06d}")

    def changes(self) -> DataFrame:
        return self._read("changes", CHANGES)

    def counts(self) -> DataFrame:
        return self._read("counts", COUNTS, self.version)

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS, self.version)

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("n_docs") >= self.least_docs)

    def postings(self) -> DataFrame:
        """(key, doc_id) of the documents in the index now."""
        return (self.changes().groupBy("key", "doc_id").agg(F.sum("sign").alias("held"))
                .where("held > 0").select("key", "doc_id"))

    # Changes -----------------------------------------------------------------------------------

    def _keys(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(doc_id, key), distinct within a row. Rows without id are left out."""
        least = self.least_chars
        find = arrow_map(lambda texts: pa.array([list(line_keys(t, least)) for t in texts],
                                                pa.list_(pa.binary())), "array<binary>")
        named = df.where(quoted(id_col).isNotNull())
        return (named.select(quoted(id_col).cast("bigint").alias("doc_id"),
                             find(quoted(text_col)).alias("keys"))
                .select("doc_id", F.explode("keys").alias("key")))

    def insert(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Add documents. Ids that are in the index already keep the lines they have; rows with the same
        id count as one document; rows without id are not counted."""
        new = self._keys(df, id_col, text_col)
        if self.version:
            new = new.join(self.postings().select("doc_id").distinct(), "doc_id", "left_anti")
        self._commit(new.distinct().select("key", "doc_id", F.lit(1).alias("sign")))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents away, as if they had never been inserted. Unknown ids do nothing."""
        gone = ids.select(quoted(id_col).cast("bigint").alias("doc_id")).distinct()
        held = self.postings().join(gone, "doc_id", "left_semi")
        self._commit(held.select("key", "doc_id", F.lit(-1).alias("sign")))

    def _commit(self, changes: DataFrame) -> None:
        """Write a batch of changes, and the counts and filters that follow from it."""
        first = not self.version
        self._write(changes, "changes")
        batch = self.spark.read.schema(CHANGES).parquet(
            f"{self.folder}/changes/{self.version + 1:06d}")
        delta = batch.groupBy("key").agg(F.sum("sign").alias("change"), F.min("sign").alias("least"),
                                         F.max("doc_id").alias("newest"))
        before = self.counts()
        if first:
            totals = delta.select("key", F.col("change").alias("n_docs"),
                                  F.col("newest").alias("last_doc"))
        else:
            totals = self._merged(before, delta, batch)
        totals = written(totals, "totals")
        frequent = totals.where(F.col("n_docs") >= self.least_docs).count()
        shards = self.shards
        if first or frequent > 2 * SHARD_KEYS * shards:
            shards = max(LEAST_SHARDS, -(-frequent // SHARD_KEYS))
        shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
        self._write(totals.select("key", shard.alias("shard"), "n_docs", "last_doc"), "counts")
        after = self.spark.read.schema(COUNTS).parquet(
            f"{self.folder}/counts/{self.version + 1:06d}")
        # With more shards all filters are built anew.
        self._write(self._new_filters(before, after, first or shards != self.shards), "filters")
        files.publish(self.spark, f"{self.folder}/manifest/{self.version + 1:06d}", json.dumps(
            {"shards": shards, "least_chars": self.least_chars, "least_docs": self.least_docs}))
        self.version, self.shards = self.version + 1, shards

    def _merged(self, before: DataFrame, delta: DataFrame, batch: DataFrame) -> DataFrame:
        """Counts after a batch. Where a holder left, the largest id is found anew among the key's
        postings; keys that nobody holds any more go."""
        both = before.join(delta, "key", "full_outer").withColumns({
            "n_docs": F.coalesce("n_docs", F.lit(0)) + F.coalesce("change", F.lit(0)),
            "last_doc": F.greatest("last_doc", "newest")}).where("n_docs > 0")
        stay = both.where("least is null or least > 0").select("key", "n_docs", "last_doc")
        left = both.where("least < 0").select("key", "n_docs")
        holders = (self.changes().unionByName(batch).join(left.select("key"), "key", "left_semi")
                   .groupBy("key", "doc_id").agg(F.sum("sign").alias("held")).where("held > 0")
                   .groupBy("key").agg(F.max("doc_id").alias("last_doc")))
        return stay.unionByName(left.join(holders, "key").select("key", "n_docs", "last_doc"))

    def _new_filters(self, before: DataFrame, after: DataFrame, first: bool) -> DataFrame:
        """Filters after a batch: keys that became frequent go in, keys that ceased to be come out. A
        shard whose filter would overflow is built anew from its exact counts."""
        enough = F.col("n_docs") >= self.least_docs
        now = after.where(enough).select("key", "shard")
        if first:
            return now.groupBy("shard").applyInPandas(built, FILTERS)
        was = before.where(enough).select("key", "shard")
        moves = (now.join(was, "key", "left_anti").withColumn("sign", F.lit(1))
                 .unionByName(was.join(now, "key", "left_anti").withColumn("sign", F.lit(-1))))
        changed = (self.filters().groupBy("shard").cogroup(moves.groupBy("shard"))
                   .applyInPandas(changed_filter, FILTERS))
        full = F.substring("filter", 1, 1) == F.lit(b"\x01")
        again = now.join(changed.where(full).select("shard"), "shard", "left_semi")
        return changed.where(~full).unionByName(again.groupBy("shard").applyInPandas(built, FILTERS))

    # Use ---------------------------------------------------------------------------------------

    def drops(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc_id, key) of the lines that cleaning takes from the documents."""
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int")
        lines = self._keys(df, id_col, text_col).select(
            F.pmod(F.xxhash64("key"), F.lit(max(self.shards, 1))).cast("int").alias("shard"),
            salt.alias("salt"), F.lit(1).alias("kind"), "key", "doc_id")
        filters = self.filters().select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"),
            F.lit(0).alias("kind"), F.col("filter").alias("key"), F.lit(None).cast("bigint").alias("doc_id"))
        # Each part is read in order: a shard's filter, then the lines that it judges.
        maybe = (filters.unionByName(lines).repartition("shard", "salt")
                 .sortWithinPartitions("shard", "salt", "kind")
                 .mapInArrow(probe, "key binary, doc_id bigint"))
        return (maybe.join(self.frequent().select("key", "last_doc"), "key")
                .where("doc_id != last_doc").select("doc_id", "key").distinct())

    def clean(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The documents with columns n_lines, n_dropped (bigint) and kept (text without the dropped
        lines, joined by \\n). Null text counts as one empty line. Columns of these names are replaced;
        rows without id lose nothing."""
        least = self.least_chars
        shape = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])

        def run(texts, dropped):
            rows = [clean(t, d, least) for t, d in zip(texts, dropped)]
            return pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], shape[i].type) for i in range(3)],
                fields=list(shape))

        doc, gone, made = (free_name(df, c) for c in ("__doc", "__gone", "__done"))
        per_doc = (self.drops(df, id_col, text_col).groupBy("doc_id")
                   .agg(F.collect_list("key").alias(gone)).withColumnRenamed("doc_id", doc))
        work = arrow_map(run, "n_lines bigint, n_dropped bigint, kept string")
        joined = df.join(per_doc, quoted(id_col).cast("bigint") == F.col(doc), "left")
        done = joined.withColumn(made, work(quoted(text_col), F.col(gone)))
        rest = [quoted(c) for c in df.columns if c.lower() not in ("n_lines", "n_dropped", "kept")]
        return done.select(*rest, f"{made}.n_lines", f"{made}.n_dropped", f"{made}.kept")


def built(keys: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard."""
    size = len(keys)
    while True:
        made = CuckooFilter.sized(size)
        made.insert(keys["key"].tolist())
        if not made.full:
            return pd.DataFrame({"shard": keys["shard"].iloc[:1], "filter": [made.dump()]})
        size *= 2


def changed_filter(key: tuple, held: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
    add = moves.loc[moves["sign"] > 0, "key"].tolist()
    filter_ = CuckooFilter.load(held["filter"].iloc[0]) if len(held) else CuckooFilter.sized(len(add))
    filter_.remove(moves.loc[moves["sign"] < 0, "key"].tolist())
    filter_.insert(add)
    return pd.DataFrame({"shard": [key[0]], "filter": [filter_.dump()]})


def probe(batches):
    """Lines that may be frequent. A filter row precedes the lines of its shard; lines of a shard
    without filter are not frequent."""
    shard, filter_ = None, None
    for batch in batches:
        shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
        keys = batch.column("key").to_pylist()
        hits, at = [], 0
        while at < len(kinds):
            if kinds[at] == 0:
                shard, filter_ = shards[at], CuckooFilter.load(keys[at])
                at += 1
                continue
            end = at + 1
            while end < len(kinds) and kinds[end] == 1 and shards[end] == shards[at]:
                end += 1
            if shard == shards[at] and filter_ is not None:
                hits += (filter_.contains(keys[at:end]).nonzero()[0] + at).tolist()
            at = end
        taken = batch.take(pa.array(hits, pa.int64()))
        yield taken.select(["key", "doc_id"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Clean a table against itself: index all of it, then clean all of it. See :meth:`LineIndex.clean`."""
    index = LineIndex(df.sparkSession, shared_dir(df.sparkSession, "lines"), least_chars, least_docs)
    index.insert(df, id_col, text_col)
    return index.clean(df, id_col, text_col)
