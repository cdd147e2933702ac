"""Mixing sources to target weights by balanced sampling (the cube method).

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share 150 % of all words. A target
stops at twice its source's words; the excess is shared anew among the others by weight. A source with target
rate r takes every document floor(r) times, and once more with probability r - floor(r). These
extra copies are chosen by the cube method: a flight moves the probabilities through the null space of
two constraints, documents and words, until they are 0 or 1, so both totals stay exactly balanced; at most
two units of a block stay open. Open units of all blocks fly again, level by level, until one block
per source is left; a dozen of its units of all sizes land in the best of all their settlements.

Blocks are cut by a hash inside a source, so a source of any size is many tasks.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillwork.llm.common import WORD, free_name, quoted, written

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Units of a block of the cube method.
BLOCK = 2000
#: Units that a source's last block holds back for the landing, besides the two that the flight leaves.
LANDING = 10
EDGE = 1e-9

UNIT = ["source", "doc_id", "size", "tag"]
OPEN = "source string, doc_id bigint, size bigint, tag bigint, copies bigint, base int, chance double"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unit_columns(id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """What tells units apart. The tag tells rows without id apart by their text."""
    text = quoted(text_col)
    return {"source": quoted(source_col).cast("string"), "doc_id": quoted(id_col).cast("bigint"),
            "size": words_in(text),
            "tag": F.when(quoted(id_col).isNull(), F.xxhash64(text)).otherwise(F.lit(0))}


def numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place (from 0) by code point, null last: sorted by ranges, so that no task
    sees more than its range; the driver adds up one count per range."""
    first = F.col("source").isNull()
    ranged = written(sources.withColumn("missing", first).repartitionByRange("missing", "source")
                     .withColumn("part", F.spark_partition_id()), "sources")
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect())
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    offsets = ranged.sparkSession.createDataFrame(starts, "part int, start bigint")
    inside = F.row_number().over(Window.partitionBy("part").orderBy("missing", "source"))
    return (ranged.withColumn("inside", inside).join(F.broadcast(offsets), "part")  # one row a range
            .withColumn("place", F.col("start") + F.col("inside") - 1).drop("missing", "part", "inside",
                                                                            "start"))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size). Each round of resharing is one
    aggregation; the driver sees its two sums."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    table = written(numbered(sources).withColumn("weight", weight), "weights")
    most, level, full = F.col("source_size") * MOST, 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > most
        row = table.agg(F.sum("source_size").alias("all"), F.count_if(above).alias("full"),
                        F.sum(F.when(above, most)).alias("stopped"),
                        F.sum(F.when(~above, F.col("weight"))).alias("weights")).first()
        if row["full"] == full or not row["weights"]:
            break
        full = row["full"]
        level = (SHARE * row["all"] - (row["stopped"] or 0.0)) / row["weights"]
    share = F.lit(level) * F.col("weight")
    return table.select("source", "source_size",
                        F.when(share > most, most).otherwise(share).cast("double").alias("target"))


def flight(chance: list[float], counts: list[float], words: list[float], rng: random.Random,
           land: bool) -> list[float]:
    """Move the chances, in order, until all but at most two (with ``land``: none) are 0 or 1, keeping
    the sums of chance * count and chance * words. Landing holds back ``LANDING`` units of all sizes and
    settles them together with what the flight leaves open."""
    chance = list(chance)
    open_ = [i for i, p in enumerate(chance) if EDGE < p < 1 - EDGE]
    held = {open_[k * len(open_) // LANDING] for k in range(LANDING)} if land and open_ else set()
    live: list[int] = []
    rest = iter([i for i in open_ if i not in held])
    while True:
        while len(live) < 3 and (i := next(rest, None)) is not None:
            live.append(i)
        if len(live) < 3:
            break
        (a, b, c), (x, y, z) = (counts[i] for i in live), (words[i] for i in live)
        move = [b * z - c * y, c * x - a * z, a * y - b * x]
        if not any(move):
            move = [b, -a, 0.0]
        up = min((1 - chance[i]) / m if m > 0 else chance[i] / -m for i, m in zip(live, move) if m)
        down = min(chance[i] / m if m > 0 else (1 - chance[i]) / -m for i, m in zip(live, move) if m)
        step = up if rng.random() * (up + down) < down else -down
        for i, m in zip(live, move):
            p = chance[i] + step * m
            chance[i] = 0.0 if p <= EDGE else 1.0 if p >= 1 - EDGE else p
        live = [i for i in live if 0.0 < chance[i] < 1.0]
    last = sorted(held.union(live)) if land else []
    for i, taken in zip(last, landing([chance[i] for i in last], [counts[i] for i in last],
                                      [words[i] for i in last])):
        chance[i] = taken
    return [float(round(p)) if p <= EDGE or p >= 1 - EDGE else p for p in chance]


def landing(chance: list[float], counts: list[float], words: list[float]) -> list[float]:
    """Of all ways to settle a few units the one with the words nearest to what was expected; then the
    one with the number of documents nearest; then the first."""
    n = len(chance)
    ways = (np.arange(2 ** n)[:, None] >> np.arange(n)) & 1
    off = np.abs((ways - np.array(chance).reshape(1, n)) @ np.array([words, counts], float).T)
    return ways[np.lexsort((off[:, 1], off[:, 0]))[0]].astype(float).tolist()


def fly(level: int, seed: int, land: bool):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by([("size", "descending"), ("doc_id", "ascending"), ("tag", "ascending")])
        copies, sizes = block["copies"].to_pylist(), block["size"].to_pylist()
        rng = random.Random(f"{seed} {level} {key[0].as_py()!r} {key[1].as_py()}")
        chance = flight(block["chance"].to_pylist(), copies, [n * s for n, s in zip(copies, sizes)], rng,
                        land)
        block = block.drop_columns(["block", "chance"])
        return block.append_column("chance", pa.array(chance, pa.float64()))

    return run


def decisions(units: DataFrame, seed: int = 0) -> DataFrame:
    """(source, doc_id, size, tag, copies: times taken) from open units (see ``OPEN``)."""
    done, rest, level = None, units, 0
    while True:
        most = rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        land = most <= BLOCK
        per = rest.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        per = per.select(F.col("source").alias("its"), "blocks")
        cut = rest.join(per, F.col("source").eqNullSafe(F.col("its"))).drop("its")
        block = F.pmod(F.xxhash64(F.lit(level), "doc_id", "size", "tag"), F.col("blocks"))
        flown = written(cut.withColumn("block", block).drop("blocks").groupBy("source", "block")
                        .applyInArrow(fly(level, seed, land), OPEN), "flight")
        closed = F.col("chance").isin(0.0, 1.0)
        part = flown.where(closed).select(
            *UNIT, (F.col("base") + F.col("chance").cast("int")).alias("times"))
        done = part if done is None else done.unionByName(part)
        if land:
            return done
        rest, level = flown.where(~closed), level + 1


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: int = 0) -> DataFrame:
    """(source, doc_id, size, tag, source_size, target, times) per row of ``df``.

    A row is taken whole, ``times`` times (0, 1 or 2). Rows with the same source, id and size (without id:
    the same text) are one unit and fare alike, repeated rows too. Texts without words and null texts have size
    0 and times 0. The same table and seed give the same plan however rows are dealt out.
    """
    columns = unit_columns(id_col, text_col, source_col)
    rows = written(df.select(*[c.alias(n) for n, c in columns.items()]), "sizes")
    units = rows.groupBy(*UNIT).agg(F.count("*").alias("copies"))
    goals = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    goals = goals.withColumnRenamed("source", "its")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(rate + EDGE)
    ready = (units.where("size > 0").join(goals, F.col("source").eqNullSafe(F.col("its")))
             .select(*UNIT, "copies", base.cast("int").alias("base"),
                     F.greatest(rate - base, F.lit(0.0)).alias("chance")))
    chosen = decisions(written(ready, "units"), seed)
    chosen = chosen.select(*[F.col(c).alias(f"c_{c}") for c in UNIT], "times")
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in UNIT]
    both = rows.join(chosen, same, "left").drop(*[f"c_{c}" for c in UNIT])
    return (both.join(goals, F.col("source").eqNullSafe(F.col("its")))
            .select(*UNIT, "source_size", "target", F.coalesce("times", F.lit(0)).alias("times")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 0) -> DataFrame:
    """The rows that the mix takes, each as often as it takes it; columns as before. See :func:`plan`."""
    columns = unit_columns(id_col, text_col, source_col)
    mine = {n: free_name(df, f"__mix_{n}") for n in UNIT}
    its = {n: free_name(df, f"__want_{n}") for n in UNIT}
    times, turn = free_name(df, "__times"), free_name(df, "__turn")
    marked = df.select(*map(quoted, df.columns), *[c.alias(mine[n]) for n, c in columns.items()])
    wanted = (plan(df, id_col, text_col, source_col, seed).where("times > 0").select(*UNIT, "times")
              .distinct().select(*[F.col(c).alias(its[c]) for c in UNIT], F.col("times").alias(times)))
    taken = marked.join(wanted, [F.col(mine[c]).eqNullSafe(F.col(its[c])) for c in UNIT])
    often = F.explode(F.sequence(F.lit(1), F.col(times))).alias(turn)
    return taken.select(*map(quoted, df.columns), often).drop(turn)
