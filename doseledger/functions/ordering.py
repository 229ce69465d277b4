"""Exact row numbers without gathering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doseledger.session import write_scratch

def null_safe(left: DataFrame, right: DataFrame, names):
    """Join condition on equal names that also pairs NULL with NULL."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def ordered_ids(df: DataFrame, order, tag: str = "ordered") -> DataFrame:
    """``df`` sorted over all tasks and written once, with ``__part`` and ``__at``: range partition and place in it.

    Both come from the row's own number, stored as a column beside it, so they hold whatever the committer calls its files.
    """
    sorted_rows = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    # the partition stands in the bits above 33, the place inside it in the others
    return write_scratch(sorted_rows, tag).select(
        *df.columns,
        F.shiftright("__id", 33).alias("__part"),
        F.col("__id").bitwiseAND(F.lit(2**33 - 1)).alias("__at"),
    )


def number_rows(df: DataFrame, order, group=(), name: str = "row_num") -> DataFrame:
    """Number rows 1, 2, 3 … per group in the given order.

    A plain window would sort a whole group in one task. Here a range sort over group and order
    columns spreads even one dominant group over many tasks and is written once; a window then sees
    one small row per group and range partition. Rows that tie in all columns of ``order`` share a run of numbers.
    """
    group = list(group)
    rows = ordered_ids(df, [*[F.col(g).asc_nulls_last() for g in group], *order])
    per_part = rows.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_scratch(
        per_part.select(
            *group, "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")
        ),
        "offsets",
    )
    joined = rows.join(offsets, null_safe(rows, offsets, [*group, "__part"]))
    return joined.select(*[rows[c] for c in df.columns], (rows["__at"] + offsets["__shift"] + 1).alias(name))


def first_rows(df: DataFrame, group, block, position: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, in order of block, then position inside the block.

    Blocks are file splits. One scan keeps the first ``limit`` rows of each group and block and writes them; rows past these are dropped
    beside the scan. How many of them the blocks hold decides what each still owes: a block cut at the limit leaves
    nothing to those behind it, so counts need no rows that were dropped. No group passes through one task.
    """
    group, block = list(group), list(block)
    inside = Window.partitionBy(*group, *block).orderBy(position)
    ranked = write_scratch(df.withColumn("__rank", F.row_number().over(inside)).filter(F.col("__rank") <= limit), "first-rows")
    earlier = (
        Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    )
    owed = write_scratch(
        ranked.groupBy(*group, *block)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__owed", F.lit(limit) - F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .filter("__owed > 0")
        .select(*group, *block, "__owed"),
        "owed",
    )
    return (
        ranked.join(owed, null_safe(ranked, owed, [*group, *block]))
        .filter(ranked["__rank"] <= owed["__owed"])
        .select(*[ranked[c] for c in df.columns])
    )
