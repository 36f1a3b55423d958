"""Sets of whole numbers as ranges that merge in any order.

A range is ``first`` to ``last``, both within. Merging is done inside blocks of numbers, then among
what is left, so that a key of any length needs no window over all its numbers: the second step sees
one range per gap or block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000


def _joined(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges that overlap or touch as one; ``keys`` tell which may."""
    in_order = Window.partitionBy(*keys).orderBy("first", "last")
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > reached + 1, F.lit(True))
    islands = ranges.withColumn("starts", starts).withColumn("island", F.count_if("starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def merge_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first, last): the fewest ranges that hold the same numbers."""
    blocked = ranges.select(*keys, "first", "last", F.expr(f"first div {BLOCK}").alias("block"))
    return _joined(_joined(blocked, [*keys, "block"]).drop("block"), keys)


def gaps_between(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first_missing, last_missing, missing) between the ranges of ``merge_ranges``."""
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("first"))
    return merged.withColumn("before", before).where(F.col("before").isNotNull()).select(
        *keys,
        (F.col("before") + 1).alias("first_missing"),
        (F.col("first") - 1).alias("last_missing"),
        (F.col("first") - F.col("before") - 1).alias("missing"),
    )
