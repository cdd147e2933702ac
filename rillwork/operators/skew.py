"""Splitting of hot groups before a shuffle.

A group is hot when the right side holds more than ``hot_rows`` rows of it. Hot groups are found by an
exact, partially aggregated count, and none is left out. Each entry of the list stands for a million rows
(``HOT_ROWS``), which bounds the list: 10^12 rows give at most 10^6 entries, some tens of MB. So it is
broadcast. Shuffling the left side to the list instead would gather a hot group in one task first.

The right group is spread over parts and the left rows of the group are repeated for each part, so
every (left, right) pair meets exactly once. A hot left group needs no help: adaptive execution
splits a skewed left partition of a left join at run time. It cannot split the right side.

A group of m left and n right rows gets at most ``spread + n / m`` parts. So what is shuffled stays below
``spread`` times the left rows plus twice the right rows, however often both sides of a group grow. Where this
bound holds parts back, the left rows are many, and their splits share the work.

Adaptive execution sizes tasks by what they read. A group of m left and n right rows makes m * n pairs of them, so where
pairs are many, they are counted first, and cells of groups are dealt over tasks of about ``PAIRS`` pairs each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000
#: Pairs of a task.
PAIRS = 5_000_000

LEFT_PART, RIGHT_PART = "_left_part", "_right_part"


def hot_groups(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int, spread: int) -> DataFrame:
    """``keys`` and the number of parts, for every group above ``hot_rows``. Left rows are counted in these
    groups only; if there are none, adaptive execution leaves that out."""
    counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    met = (left.select(*keys).join(F.broadcast(counts.select(*keys)), keys, "left_semi")
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")))
    parts = F.least(F.ceil(F.col("_n") / hot_rows), spread + F.floor(F.col("_n") / F.col("_m")))
    return counts.join(met, keys, "left").select(*keys, parts.cast("int").alias("_parts"))


def _groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All groups with the numbers of their left and right rows and of their pairs, unmatched left rows included."""
    n = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    m = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    pairs = F.coalesce("_m", F.lit(0)).cast("double") * F.coalesce("_n", F.lit(1))
    return m.join(n, keys, "full").withColumn("_pairs", pairs)


def tasks_for(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int, pairs: int) -> tuple[int, bool]:
    """How many tasks of so many pairs a left join has, and whether a group must be split: a Spark job counts."""
    split = (F.col("_pairs") > pairs) | (F.col("_n") > hot_rows)
    total, some = _groups(left, right, keys).agg(F.sum("_pairs"), F.max(split)).first()
    return max(1, -int(-(total or 0) // pairs)), bool(some)


def deal(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int, spread: int, pairs: int
         ) -> tuple[DataFrame, DataFrame]:
    """Add part columns to both sides; join on ``keys`` plus those two. A group above ``hot_rows`` right rows is
    split as in :func:`split_right`; where its parts have more than ``pairs`` pairs, its left rows are spread too
    and its right rows repeated. Each group of the list stands for that many rows or pairs."""
    parts = F.when(F.col("_n") > hot_rows, F.least(
        F.ceil(F.col("_n") / hot_rows), spread + F.floor(F.col("_n") / F.col("_m")))).otherwise(1)
    cells = (_groups(left, right, keys).withColumn("_parts", parts.cast("int"))
             .withColumn("_cells", F.greatest(F.ceil(F.col("_pairs") / (F.col("_parts") * pairs)), F.lit(1)).cast("int"))
             .where("_parts > 1 or _cells > 1").select(*keys, "_parts", "_cells"))
    hot = F.broadcast(cells)
    lhs = left.join(hot, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    lhs = lhs.select(*left.columns, "_parts", part_of(left.columns, F.coalesce("_cells", F.lit(1))).alias(LEFT_PART),
                     every_part(F.col("_parts")).alias(RIGHT_PART))
    rhs = right.join(hot, keys, "left").withColumn("_cells", F.coalesce("_cells", F.lit(1)))
    return lhs, rhs.select(*right.columns, part_of(right.columns, F.coalesce("_parts", F.lit(1))).alias(RIGHT_PART),
                           every_part(F.col("_cells")).alias(LEFT_PART))


def part_of(row_cols: list[str], parts: Column) -> Column:
    # A hash of the row itself: a re-run task puts each row in the same part again.
    return F.pmod(F.xxhash64(*row_cols), parts).cast("int")


def every_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def split_right(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame,
                right_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Add a part column to both sides; join on ``keys`` plus that one.

    ``_parts`` stays on the left side: where it exceeds 1 the right group is not empty, so an
    unmatched copy of a left row is one of its repeats and must be dropped after an outer join.
    """
    hot = F.broadcast(hot)
    lhs = left.join(hot, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    lhs = lhs.select(*left.columns, "_parts", every_part(F.col("_parts")).alias(RIGHT_PART))
    rhs = right.join(hot, keys, "left")
    return lhs, rhs.select(*right.columns,
                           part_of(right_cols, F.coalesce("_parts", F.lit(1))).alias(RIGHT_PART))
