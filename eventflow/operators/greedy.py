"""Greedy windows: the first point opens a window, every point up to ``width`` later is in it, the next point opens
the next one. Which points open windows depends on all earlier ones, so a plain scan is one task per group.

Here a group is cut into blocks of time, and a block becomes a function: from the point at which the chain of
windows enters it to the point at which the chain enters a later block. In blocks of one width that is a single
hop, the first point after ``t + width``, read off a time-bucketed window. Two neighbouring blocks' functions
compose by one equi-join on (group, point), and only points within two widths of a block's begin can be entered,
so the tables halve from level to level. Once a block spans the longest group, its entry is known (the first
point), and the levels are walked down again: each gives the entries of its halves. Joins and windows meet a
group's rows by (group, point) or (group, block), never by group alone, so one endless group is spread over all
tasks; log2(span / width) levels are built, each cut from its lineage by ``checkpoint()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.operators.sequences import left_null_safe
from eventflow.session import shared_dir

#: Levels walked down in one plan; then the entries are checkpointed.
LEVELS_A_PLAN = 6


def greedy_windows(points: DataFrame, group: Sequence[str], first: str, t: str, width: int) -> DataFrame:
    """group..., start, end (first and last point), n (points) of the greedy windows of every group.

    ``first`` is the group column that holds the group's first point. ``t`` and it are longs without nulls;
    neighbouring points of a group must be at most ``width`` apart (cut wider gaps into groups: a window never
    reaches over one). Null values in other group columns are values; equal points count each; an empty table
    has no windows. Jobs run when this is called."""
    shared_dir(points.sparkSession)  # sets the checkpoint folder
    group = list(group)
    spots = points.groupBy(*group, F.col(t).alias("_t")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_st", F.col(first)).checkpoint()
    longest = spots.agg(F.max(F.col("_t") - F.col("_st"))).first()[0] or 0
    if longest <= width:
        return spots.groupBy(*group).agg(F.min("_t").alias("start"), F.max("_t").alias("end"), F.sum("_n").alias("n"))
    levels = [_hops(spots, group, width).checkpoint()]
    while width << len(levels) <= longest:
        levels.append(_compose(levels[-1], group, width << len(levels), width).checkpoint())
    entered = spots.where(F.col("_t") == F.col("_st")).select(*group, "_st", "_t")
    for k in range(len(levels) - 1, -1, -1):
        found = left_null_safe(entered, levels[k].select(*group, "_t", "_x"), [*group, "_t"])
        inside = _block("_x", width << (k + 1)) == _block("_t", width << (k + 1))
        both = F.when(inside, F.array("_t", "_x")).otherwise(F.array("_t"))
        entered = found.select(*group, "_st", F.explode(both).alias("_t"))
        if k and k % LEVELS_A_PLAN == 0:
            entered = entered.checkpoint()
    return _members(spots, entered, group, width)


def _block(t: str, width: int) -> Column:
    """Number of the block of ``width`` that ``t`` is in, counted from its group's first point."""
    return F.floor((F.col(t) - F.col("_st")) / F.lit(width))


def _hops(spots: DataFrame, group: list[str], width: int) -> DataFrame:
    """For every point that has one, the first point after ``_t + width`` (``_x``). It is at most two widths away, so the
    question, asked in the next block, meets the points of that block and the one after."""
    b = _block("_t", width)
    rows = F.array(F.struct(b.alias("_b"), F.col("_t").alias("_q"), F.lit(True).alias("_p")),
                   F.struct((b - 1).alias("_b"), F.col("_t").alias("_q"), F.lit(True).alias("_p")),
                   F.struct((b + 1).alias("_b"), (F.col("_t") + F.lit(width)).alias("_q"), F.lit(False).alias("_p")))
    d = spots.select(*group, "_st", F.explode(rows).alias("_r")).select(*group, "_st", "_r.*")
    after = (Window.partitionBy(*group, "_b").orderBy(F.col("_q").desc(), F.col("_p"))
                   .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_x", F.last(F.when(F.col("_p"), F.col("_q")), ignorenulls=True).over(after))
    d = d.where(~F.col("_p") & F.col("_x").isNotNull())
    return d.select(*group, "_st", (F.col("_q") - F.lit(width)).alias("_t"), "_x")


def _compose(level: DataFrame, group: list[str], block: int, width: int) -> DataFrame:
    """The functions of blocks twice as wide (``block``): an exit that stays inside is followed once more."""
    then = level.select(*group, F.col("_t").alias("_x"), F.col("_x").alias("_xx"))
    may = level.where(F.col("_t") - F.col("_st") - _block("_t", block) * F.lit(block) <= F.lit(2 * width))
    d = left_null_safe(may, then, [*group, "_x"])
    inside = _block("_x", block) == _block("_t", block)
    return d.select(*group, "_st", "_t", F.when(inside, F.col("_xx")).otherwise(F.col("_x")).alias("_x")).where(F.col("_x").isNotNull())


def _members(spots: DataFrame, starts: DataFrame, group: list[str], width: int) -> DataFrame:
    """Windows with their points: the last start at or before a point lies in the point's block or the one before."""
    b = _block("_t", width)
    none = F.lit(None).cast("long")
    opened = starts.select(*group, F.explode(F.array(b, b + 1)).alias("_b"), "_t", F.col("_t").alias("_s"), none.alias("_n"))
    d = opened.unionByName(spots.select(*group, b.alias("_b"), "_t", none.alias("_s"), "_n"))
    till = (Window.partitionBy(*group, "_b").orderBy("_t", F.col("_n").isNotNull())
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("start", F.last("_s", ignorenulls=True).over(till)).where(F.col("_n").isNotNull())
    return d.groupBy(*group, "start").agg(F.max("_t").alias("end"), F.sum("_n").alias("n"))
