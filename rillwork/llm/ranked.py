"""Ranked lexical search with per-term geometric blocking.

A term adds weight * impact to a document's score; the weight falls with the number of documents that hold the
term, the impact grows with its occurrences and falls with the document's length (integer arithmetic
throughout, so scores are exact). Each task indexes the documents of its partition slice by slice:

* the posting list of a term is clustered by the similarity of its documents (projections of their impact
  vectors, spherical k-means with first centres taken from the list), and a cluster is a block;
* a block keeps the coordinatewise maximum of its documents' impact vectors as its summary;
* a query visits the blocks of its terms' lists. The product of query and summary bounds the score of every
  document in the block, so the block is skipped if, and only if, that bound lies below the score that the query's
  k-th best document has so far. Documents that are in no skipped block are scored exactly.

Documents stay where they are: only the best k of each task and query are shuffled. First thresholds are the exact
scores of a hash sample of the documents; they change how much is skipped, never the result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillwork.llm.common import quoted, written
from rillwork.llm.terms import terms_of

#: Queries that one pass over the documents serves (their terms are the index's coordinates).
QUERIES = 256
#: Documents of a slice, and about how many a block of a posting list holds.
DOCS, BLOCK = 2048, 64
#: Blocks whose summaries are compared at once, dimensions of the projections.
CHUNK, DIMENSIONS = 256, 32
#: Times that the centres of a list's clusters are moved.
ROUNDS = 2
#: One document in so many gives the first thresholds.
SEEDS = 64
#: Saturation of an occurrence count, in thousandths of the length norm, and the share of the norm (per cent) that
#: follows the length; fixed by the scoring formula.
SCALE, SATURATION, BY_LENGTH = 1_000_000_000, 8, 75

FORWARD = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
FOUND = "query int, doc_id bigint, score bigint"


def forward_rows(number: dict[bytes, int]):
    """(doc_id, terms in all, numbers and occurrences of the queries' terms) of each document."""
    def run(batches):
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                held = Counter(terms_of(text))
                mine = sorted((number[t], c) for t, c in held.items() if t in number)
                sizes.append(sum(held.values()))
                terms.append([t for t, _ in mine])
                counts.append([c for _, c in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])

    return run


def impacts(sizes: list[int], per_doc: np.ndarray, counts: np.ndarray, n_docs: int, length: int
            ) -> np.ndarray:
    """Impact of each posting; ``per_doc`` says how many postings a document has."""
    norm = [100 - BY_LENGTH + BY_LENGTH * n * n_docs // length for n in sizes]  # Python integers: no overflow
    return SCALE * counts // (1000 * counts + SATURATION * np.repeat(np.array(norm, np.int64), per_doc))


def expand(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())


class Queries:
    """A set of queries as (terms x queries) weights."""

    def __init__(self, weighted: list[dict[int, int]], n_terms: int):
        self.table = np.zeros((n_terms, len(weighted)))  # whole numbers below 2**53: sums are exact
        for q, terms in enumerate(weighted):
            for t, w in terms.items():
                self.table[t, q] = w
        self.holds = self.table > 0
        self.rarity = self.table.max(axis=1)
        # Projection of the coordinates: the same in every task.
        self.signs = np.random.default_rng(17).standard_normal((n_terms, DIMENSIONS)).astype(np.float32)


class Slice:
    """An index of some documents: posting lists in blocks."""

    def __init__(self, ids, bounds: np.ndarray, terms: np.ndarray, impact: np.ndarray, queries: Queries):
        self.ids, self.bounds, self.terms, self.impact, self.queries = ids, bounds, terms, impact, queries
        doc = np.repeat(np.arange(len(ids)), np.diff(bounds))
        by_term = np.argsort(terms, kind="stable")
        spans = np.flatnonzero(np.r_[True, np.diff(terms[by_term]) != 0, True]) if len(terms) else []
        near = self.projections(doc)
        self.lists = []  # (term, documents of a block), lists one after the other
        for low, high in zip(spans[:-1], spans[1:]):
            posted = doc[by_term[low:high]]
            self.lists += [(int(terms[by_term[low]]), block) for block in clusters(posted, near)]

    def projections(self, doc: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.ids), DIMENSIONS), np.float32)
        weight = (self.impact * self.queries.rarity[self.terms]).astype(np.float32)
        for d in range(DIMENSIONS):
            out[:, d] = np.bincount(doc, self.queries.signs[self.terms, d] * weight, len(self.ids))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)

    def candidates(self, least: np.ndarray) -> np.ndarray:
        """(document, query): some list of the query has the document, and no block with it is bound to score
        less than ``least`` of the query."""
        seen, out = (np.zeros((len(self.ids), len(least)), bool) for _ in range(2))
        for i in range(0, len(self.lists), CHUNK):
            part = self.lists[i:i + CHUNK]
            asked = self.queries.holds[[t for t, _ in part]]
            mine = np.flatnonzero(asked.any(axis=0))
            bound = self.summaries([docs for _, docs in part]) @ self.queries.table[:, mine]
            asked = asked[:, mine]
            fails = asked & (bound < least[mine])
            for (_, docs), visits, skips in zip(part, asked, fails):
                seen[np.ix_(docs, mine[visits])] = True
                if skips.any():
                    out[np.ix_(docs, mine[skips])] = True
        return seen & ~out

    def summaries(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Per block the coordinatewise maximum of its documents' impacts."""
        docs = np.concatenate(blocks)
        starts, ends = self.bounds[docs], self.bounds[docs + 1]
        of = np.repeat(np.repeat(np.arange(len(blocks)), [len(b) for b in blocks]), ends - starts)
        at = expand(starts, ends)
        width = self.queries.table.shape[0]
        out = np.zeros(len(blocks) * width)
        np.maximum.at(out, of * width + self.terms[at], self.impact[at].astype(np.float64))
        return out.reshape(len(blocks), width)

    def scores(self, docs: np.ndarray, query: int) -> np.ndarray:
        """Exact scores of some documents."""
        starts, ends = self.bounds[docs], self.bounds[docs + 1]
        at = expand(starts, ends)
        value = self.queries.table[self.terms[at], query].astype(np.int64) * self.impact[at]
        total = np.r_[0, np.cumsum(value)]
        edge = np.cumsum(ends - starts)
        return total[edge] - total[edge - (ends - starts)]


def clusters(posted: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
    """The documents of a posting list in groups of similar ones."""
    if len(posted) <= BLOCK:
        return [posted]
    points = near[posted]
    centres = points[::BLOCK]
    for _ in range(ROUNDS):
        nearest = np.argmax(points @ centres.T, axis=1)
        centres = np.zeros_like(centres)
        np.add.at(centres, nearest, points)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-30)
    nearest = np.argmax(points @ centres.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    return np.split(posted[order], np.flatnonzero(np.diff(nearest[order])) + 1)


def searcher(weighted: list[dict[int, int]], n_terms: int, n_docs: int, length: int, least: list[int], k: int):
    """The best k documents per query of a partition."""
    def run(batches):
        queries = Queries(weighted, n_terms)
        floor = np.array(least, np.float64)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in weighted]  # (scores, ids)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                ids, sizes, terms, counts = batch.slice(i, DOCS).columns
                ids = ids.to_numpy(zero_copy_only=False)
                per_doc = np.diff(terms.offsets.to_numpy())
                numbers = terms.flatten().to_numpy(zero_copy_only=False)
                impact = impacts(sizes.to_pylist(), per_doc,
                                 counts.flatten().to_numpy(zero_copy_only=False), n_docs, length)
                index = Slice(ids, np.r_[0, np.cumsum(per_doc)], numbers, impact, queries)
                chosen = index.candidates(floor)
                for q in np.flatnonzero(chosen.any(axis=0)):
                    docs = np.flatnonzero(chosen[:, q])
                    score = np.concatenate([best[q][0], index.scores(docs, q)])
                    names = np.concatenate([best[q][1], ids[docs]])
                    top = np.lexsort((names, -score))[:k]
                    top = top[score[top] > 0]
                    best[q] = score[top], names[top]
                    if len(top) == k:
                        floor[q] = max(floor[q], score[top[-1]])
        size = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), size), pa.int32()),
             pa.array(np.concatenate([i for _, i in best]), pa.int64()),
             pa.array(np.concatenate([s for s, _ in best]), pa.int64())], ["query", "doc_id", "score"])

    return run


def best_of(found: DataFrame, k: int, by: str) -> DataFrame:
    """The k highest scores per ``by`` with their rank; each task passes on k rows at most."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, queries: list[list[bytes]], k: int) -> DataFrame:
    """(query, doc_id, score) with the best k of each query, from (doc_id, text)."""
    number = {t: i for i, t in enumerate(sorted({t for q in queries for t in q}))}
    if not number:
        return docs.sparkSession.createDataFrame([], FOUND)
    forward = written(docs.mapInArrow(forward_rows(number), FORWARD).where("n > 0"), "forward")
    total = forward.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = total["docs"], total["length"] or 0
    if not n_docs:
        return docs.sparkSession.createDataFrame([], FOUND)
    held = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
              for r in held}  # one row per term of the queries
    weighted = [{number[t]: c * weight[number[t]] for t, c in Counter(q).items() if number[t] in weight}
                for q in queries]
    ranked = forward.where("doc_id is not null and size(terms) > 0").select("doc_id", "n", "terms", "counts")

    def best(rows: DataFrame, least: list[int]) -> DataFrame:
        return rows.mapInArrow(searcher(weighted, len(number), n_docs, length, least, k), FOUND)

    seeds = ranked.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEEDS)) == 0)
    seen = best_of(best(seeds, [1] * len(queries)), k, "query").where(F.col("rank") == k).collect()
    least = [1] * len(queries)
    for r in seen:
        least[r["query"]] = r["score"]
    return best(ranked, least)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """The k documents with the highest scores for each item: item_id, rank (from 1), doc_id, score.

    Equal scores rank by ascending doc_id; documents with score 0 are left out. Null and empty texts have no
    terms: such documents are neither counted nor found, such items find nothing. Documents without id
    are counted, but not found. Each row is a document of its own, repeated ones too; a repeated item is
    searched once, and two texts under one item id are ranked each on its own. Items are searched
    in blocks of about ``QUERIES``; each block is one pass over the documents.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text")).where(
        "text is not null")
    asked = items.select(quoted(item_col).alias("item_id"), quoted(query_col).alias("text")).where(
        "text is not null").distinct()
    blocks = max(1, -(-asked.count() // QUERIES))
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    out = []
    for block in range(blocks):
        mine = asked.where(F.col("block") == block).orderBy("item_id", "text").collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)],
                                      f"query int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        found = best_of(search_block(rows, [terms_of(r["text"]) for r in mine], k), k, "query")
        out.append(found.join(F.broadcast(names), "query")  # about QUERIES rows
                   .select("item_id", "rank", "doc_id", "score"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
