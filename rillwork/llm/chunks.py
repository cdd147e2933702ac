"""Substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text. A byte is a cut if its hash is the smallest among ``REACH``
bytes before and after it, so chunks are ``REACH`` bytes at least and about twice that on average, and
a cut depends on its surroundings only: an insertion moves the cuts near it and no others. Chunks are
compared by 128-bit digest. A chunk that stands at two places, of two documents or of one, is repeated; it
stays in the document with the smallest id, at its first place there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillwork.llm.common import SLICE, arrow_map, free_name, quoted, written

#: Bytes that a gear hash looks back on, and bytes on either side of a cut with larger hashes.
ROLL, REACH = 32, 24
#: Runs of repeated chunks shorter than so many code points are left alone: stock phrases.
LEAST_SPAN = 64
GEAR = np.random.default_rng(20_240_601).integers(0, 2 ** 32, 256, dtype=np.uint32)
PAD = b"\x00" * (ROLL + REACH)


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of GEAR[byte k back] << k over ROLL bytes, by doubling."""
    out = GEAR[data]
    step = 1
    while step < ROLL:
        out[step:] = out[step:] + (out[:-step] << np.uint32(step))
        step *= 2
    return out


def lowest_before(values: np.ndarray) -> np.ndarray:
    """At each place the smallest of the REACH values before it."""
    top = np.uint32(2 ** 32 - 1)
    low, size = values.copy(), 1
    while size < REACH:
        step = min(size, REACH - size)
        low[step:] = np.minimum(low[step:], low[:-step])
        size += step
    return np.concatenate([[top], low[:-1]])


def cut_batch(texts: list[str]) -> list[tuple[bytes, np.ndarray]]:
    """(bytes, chunk borders) of each text; borders start with 0 and end with the length in bytes, and
    fall on code points. An empty text has the border 0 alone."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(PAD + PAD.join(raw) + PAD, np.uint8)
    rolled = gear(data)
    after = lowest_before(rolled[::-1])[::-1]
    cut = (rolled < lowest_before(rolled)) & (rolled <= after)
    spots = np.flatnonzero(cut) + 1
    inside = (data & 0xC0) == 0x80  # a code point's later bytes
    while (late := inside[spots]).any():
        spots = spots + late
    out, start = [], len(PAD)
    for b in raw:
        low, high = np.searchsorted(spots, [start + 1, start + len(b)])
        borders = np.unique(np.concatenate([[0], spots[low:high] - start, [len(b)]]))
        out.append((b, borders))
        start += len(b) + len(PAD)
    return out


CHUNKS = "doc_id bigint, start bigint, end bigint, h1 bigint, h2 bigint, again boolean"


def seen_before(digests: list[bytes]) -> list[bool]:
    """For each digest whether the list holds it earlier."""
    known: set[bytes] = set()
    return [d in known or known.add(d) is not None for d in digests]


def chunk_rows(by_text: bool):
    """(doc_id, start, end in code points, two halves of the digest, whether the text holds the chunk earlier) of
    each chunk; with ``by_text`` also a digest of the whole text, which tells rows with the same id apart."""
    import xxhash
    digest = xxhash.xxh3_128_digest
    names = [c.split()[0] for c in CHUNKS.split(", ")] + ["whole"] * by_text

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                docs, starts, ends, digests, again, wholes = [], [], [], [], [], []
                for doc, (b, borders) in zip(ids, cut_batch(texts)):
                    if len(b) == 0:
                        continue
                    edges = borders.tolist()
                    own = [digest(b[s:e]) for s, e in zip(edges, edges[1:])]
                    digests += own
                    again += seen_before(own)
                    count = np.r_[0, np.cumsum((np.frombuffer(b, np.uint8) & 0xC0) != 0x80)][borders]
                    starts.append(count[:-1])
                    ends.append(count[1:])
                    docs.append(np.full(len(edges) - 1, doc))
                    if by_text:
                        wholes.append(np.full(len(edges) - 1, xxhash.xxh3_64_intdigest(b), np.uint64))
                if docs:
                    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                    cols = [*map(np.concatenate, (docs, starts, ends)), halves[:, 0], halves[:, 1]]
                    cols = [pa.array(c, pa.int64()) for c in cols] + [pa.array(again)]
                    cols += [pa.array(np.concatenate(wholes).view(np.int64))] if by_text else []
                    yield pa.RecordBatch.from_arrays(cols, names)

    return run


def repeated_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False
                    ) -> DataFrame:
    """(doc_id, start, end, first_doc, again) of every chunk that stands at two places; ``by_text``: and whole."""
    docs = (df.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
            .where("doc_id is not null and text is not null"))
    chunks = written(docs.mapInArrow(chunk_rows(by_text), CHUNKS + ", whole bigint" * by_text), "chunks")
    shared = (chunks.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"),
                                             F.max("doc_id").alias("last_doc"),
                                             F.max("again").alias("inside"))
              .where("first_doc < last_doc or inside").select("h1", "h2", "first_doc"))
    return chunks.join(shared, ["h1", "h2"]).drop("h1", "h2")


def spans_of(repeated: DataFrame, least_span: int) -> DataFrame:
    """Runs of touching chunks of a document, at least ``least_span`` code points long."""
    by = [c for c in ("doc_id", "whole") if c in repeated.columns]
    before = Window.partitionBy(*by).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, 0)
    fresh = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    runs = repeated.withColumn("fresh", fresh).withColumn(
        "run", F.count_if("fresh").over(upto))
    return (runs.groupBy(*by, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"),
        F.count_if((F.col("first_doc") < F.col("doc_id")) | F.col("again")).alias("n_dropped"),
        F.min("first_doc").alias("first_doc"))
        .where(F.col("end") - F.col("start") >= least_span).drop("run"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   least_span: int = LEAST_SPAN) -> DataFrame:
    """One row per passage that stands at another place as well, in another document or the same:

    doc_id, start, end (code points, end exclusive), n_chunks, n_dropped (chunks that an earlier document
    holds, or this one further up), first_doc (smallest id that holds one of the chunks). Documents that repeat
    nothing have no row. Rows without id or text are left out; rows with the same id count as one document, its
    passages merged. Whole texts are cut; a text without any cut is one chunk.
    """
    return spans_of(repeated_chunks(df, id_col, text_col), least_span)


def drop_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_span: int = LEAST_SPAN) -> DataFrame:
    """The documents with each repeated passage left only where its id is smallest, once; columns as before. Rows
    with the same id and different texts lose each their own passages."""
    import xxhash
    gone = spans_of(repeated_chunks(df, id_col, text_col, by_text=True)
                    .where("first_doc < doc_id or again"), least_span)
    its, cuts, whole, own = (free_name(df, c) for c in ("its", "cuts", "whole", "own"))
    per_doc = gone.groupBy(F.col("doc_id").alias(its), F.col("whole").alias(whole)).agg(
        F.collect_list(F.struct("start", "end")).alias(cuts))
    digest = arrow_map(lambda texts: pa.array(np.array(
        [0 if t is None else xxhash.xxh3_64_intdigest(t.encode()) for t in texts], np.uint64).view(np.int64)), "bigint")

    def run(texts, spans):
        return pa.array([without(t, c) for t, c in zip(texts, spans)], pa.string())

    joined = df.withColumn(own, digest(quoted(text_col))).join(
        per_doc, (quoted(id_col).cast("bigint") == F.col(its)) & (F.col(own) == F.col(whole)), "left")
    text = arrow_map(run, "string")(quoted(text_col), F.col(cuts))
    return joined.withColumn(text_col, text).select(*map(quoted, df.columns))


def without(text: str | None, spans: list[dict] | None) -> str | None:
    if not text or not spans:
        return text
    kept, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        kept.append(text[at:s["start"]])
        at = max(at, s["end"])
    return "".join([*kept, text[at:]])
