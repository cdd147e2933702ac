"""SimHash near-duplicates with vantage-point trees.

Fingerprints within ``radius`` bits are linked, exactly. A vantage-point tree over a bounded sample
splits the space into shards: a node has a vantage fingerprint v and a Hamming distance m, and sends
x inside if d(x, v) <= m. By the triangle inequality a partner of x can lie on the other side only if
x is within ``radius`` of the boundary, so x visits just the shards that overlap its ball. Inside a
shard the same bounds prune a join of two point sets, recursively, down to small blocks that are compared
bit by bit. Shards report a spanning set of links, never all pairs of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rillwork.llm.common import arrow_map, least_by_hash, quoted, written
from rillwork.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Most fingerprints of the sample that the driver builds the shard tree from.
TREE_SAMPLE = 4096
#: A shard is split into blocks of about this many fingerprints a side.
BLOCK_ROWS = 100_000
#: Home fingerprints of a shard that the depth of the shard tree aims at, and the least depth.
SHARD_ROWS, LEAST_DEPTH = 250_000, 5
LEAF, CHUNK, PENDING = 64, 16_384, 200_000


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of all word shingles; zero without words; as a signed integer."""
    import xxhash
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][:max(1, len(words) - SHINGLE + 1)]
    ends = ends[min(SHINGLE, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), "<u8", n)
    bits = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        part = np.unpackbits(hashes[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        bits += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", to: str = "fingerprint") -> DataFrame:
    """The frame with a bigint fingerprint; a column of that name is replaced."""
    column = arrow_map(lambda texts: pa.array([fingerprint(t) for t in texts], pa.int64()), "bigint")
    return df.withColumn(to, column(quoted(text_col)))


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


@dataclass
class Node:
    vantage: np.uint64
    within: int
    inside: Node | int
    outside: Node | int


def build_tree(sample: np.ndarray, depth: int) -> Node | int:
    """A tree whose leaves are shard numbers from 0 upwards, in order."""
    count = 0

    def grow(points, level):
        nonlocal count
        if level and len(points) > 1:
            vantage = points[len(points) // 2]
            d = distance(points, vantage)
            within = int(np.median(d))
            inner = d <= within
            if inner.all():
                within = int(d.max()) - 1
                inner = d <= within
            if inner.any() and not inner.all():
                return Node(vantage, within, grow(points[inner], level - 1),
                            grow(points[~inner], level - 1))
        count += 1
        return count - 1

    return grow(np.unique(sample), depth)


def route(tree: Node | int, points: np.ndarray, radius: int):
    """(shard, index, at home) of every shard that a point belongs to or must visit."""
    shards, rows, homes = [], [], []

    def walk(node, at, home):
        if not len(at):
            return
        if not isinstance(node, Node):
            shards.append(np.full(len(at), node, np.int32))
            rows.append(at)
            homes.append(home)
            return
        d = distance(points[at], node.vantage)
        inner = d <= node.within
        reach = inner | (d - node.within <= radius)
        walk(node.inside, at[reach], home[reach] & inner[reach])
        reach = ~inner | (node.within + 1 - d <= radius)
        walk(node.outside, at[reach], home[reach] & ~inner[reach])

    walk(tree, np.arange(len(points)), np.ones(len(points), bool))
    if not shards:
        return np.array([], np.int32), np.array([], np.int64), np.array([], bool)
    shards, rows, homes = np.concatenate(shards), np.concatenate(rows), np.concatenate(homes)
    # A pair of two shards is found once, in the later one.
    home_of = np.empty(len(points), np.int32)
    home_of[rows[homes]] = shards[homes]
    keep = shards >= home_of[rows]
    return shards[keep], rows[keep], homes[keep]


class Groups:
    """Union-find over positions, by rounds of smallest labels."""

    def __init__(self, n: int):
        self.label, self.a, self.b, self.waiting = np.arange(n), [], [], 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.waiting += len(a)
        if self.waiting >= PENDING:
            self.settle()

    def settle(self) -> np.ndarray:
        if self.waiting:
            a, b = np.concatenate(self.a), np.concatenate(self.b)
            while True:
                x, y = self.label[a], self.label[b]
                open_ = x != y
                if not open_.any():
                    break
                a, b, x, y = a[open_], b[open_], x[open_], y[open_]
                np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(up := self.label[self.label], self.label):
                    self.label = up
            self.a, self.b, self.waiting = [], [], 0
        return self.label


def join_points(points: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, groups: Groups):
    """Link every a to every b (positions in ``points``) within the radius."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if not len(a) or not len(b):
            continue
        if len(a) > LEAF:
            vantage = points[a[len(a) // 2]]
            da, db = distance(points[a], vantage), distance(points[b], vantage)
            within = int(np.median(da))
            inner = da <= within
            if inner.all():
                within = int(da.max()) - 1
                inner = da <= within
            if inner.any() and not inner.all():
                stack.append((a[inner], b[db - within <= radius]))
                stack.append((a[~inner], b[within + 1 - db <= radius]))
                continue
        for i in range(0, len(a), LEAF):
            rows = a[i:i + LEAF]
            for k in range(0, len(b), CHUNK):
                cols = b[k:k + CHUNK]
                near = np.bitwise_count(points[rows][:, None] ^ points[cols]) <= radius
                r, c = np.nonzero(near)
                if not len(r):
                    continue
                # Of each column its first row, and what ties its other rows to that one.
                first = near.argmax(axis=0)
                hit = np.unique(c)
                groups.link(cols[hit], rows[first[hit]])
                ties = np.unique(r * LEAF + first[c])
                groups.link(rows[ties // LEAF], rows[ties % LEAF])


def block_links(block: pd.DataFrame, radius: int) -> pd.DataFrame:
    """(a, b) of each fingerprint that is linked in the block and the smallest of its group there."""
    points, at = np.unique(block["fp"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    left = block["home"].to_numpy(bool)
    groups = Groups(len(points))
    join_points(points, np.unique(at[left]), np.unique(at[~left]), radius, groups)
    label = groups.settle()
    moved = label != np.arange(len(points))
    return pd.DataFrame({"a": points[moved].view(np.int64), "b": points[label[moved]].view(np.int64)})


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all fingerprints ``fp`` within the radius, not all their pairs.

    ``distinct`` holds each fingerprint once. Only counts per shard and a sample of at most
    ``TREE_SAMPLE`` fingerprints reach the driver.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    depth = max(LEAST_DEPTH, int(np.ceil(np.log2(max(total, 1) / SHARD_ROWS))))
    sample = least_by_hash(distinct, "fp", TREE_SAMPLE, total).collect()
    tree = build_tree(np.array([r["fp"] for r in sample], np.int64).view(np.uint64), depth)

    def places(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            shard, row, home = route(tree, fps.view(np.uint64), radius)
            for i in range(0, len(shard), CHUNK):
                part = slice(i, i + CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[part]), pa.array(fps[row[part]]), pa.array(home[part])],
                    ["shard", "fp", "home"])

    placed = written(distinct.select("fp").mapInArrow(places, "shard int, fp bigint, home boolean"),
                     "shards")
    sizes = placed.groupBy("shard").agg(F.count_if("home").alias("h"), F.count("*").alias("n"))
    parts = {r["shard"]: (-(-r["h"] // BLOCK_ROWS), -(-r["n"] // BLOCK_ROWS)) for r in
             sizes.collect()}
    cut = spark.createDataFrame([(s, max(h, 1), max(n, 1)) for s, (h, n) in parts.items()],
                                "shard int, hs int, ns int")
    dealt = placed.join(F.broadcast(cut), "shard")  # one row per shard, a number chosen above
    spot = F.xxhash64("fp")
    homes = dealt.where("home").select(
        "shard", F.pmod(spot, "hs").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("ns") - 1)).alias("j"), "fp", F.lit(True).alias("home"))
    others = dealt.select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("i"),
        F.pmod(spot, "ns").cast("int").alias("j"), "fp", F.lit(False).alias("home"))
    return (homes.unionByName(others).groupBy("shard", "i", "j")
            .applyInPandas(lambda block: block_links(block, radius), "a bigint, b bigint"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """One row (doc_id, fp, component_id) per row of ``df``.

    Texts are compared whole, with A-Z lower-cased; a null, empty or blank text has fingerprint zero
    and is linked like any other. ``component_id`` is the smallest id that can be reached; a null id takes
    part but never is that smallest one (it is null only if the whole component has no id). Repeated rows
    give repeated rows. Other columns are not looked at.
    """
    docs = df.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
    prints = written(fingerprints(docs, to="fp").select("doc_id", "fp"), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    grouped = groups.join(distinct, "fp")
    lowest = grouped.groupBy("label").agg(F.min("least").alias("lowest"))
    found = distinct.join(grouped.join(lowest, "label").select("fp", "lowest"), "fp", "left")
    found = found.select("fp", F.when(F.col("lowest").isNull(), F.col("least"))
                         .otherwise(F.col("lowest")).alias("component_id"))
    return prints.join(found, "fp").select("doc_id", "fp", "component_id")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay when one document of each group does: the one with the smallest id
    (of repeated rows with that id, any one). Rows without id all stay. Columns as before."""
    keep = (near_duplicates(df.where(quoted(id_col).isNotNull()), id_col, text_col)
            .where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct())
    named = df.where(quoted(id_col).isNotNull()).join(keep, id_col, "left_semi")
    return named.dropDuplicates([id_col]).select(*map(quoted, df.columns)).unionByName(
        df.where(quoted(id_col).isNull()))
