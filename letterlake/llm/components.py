"""Connected components of a graph given as pairs, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.llm.common import kept


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest node around it.

    ``larger``: only the neighbours above the node move, over edges of both directions; else the node
    and its neighbours below it. Both keep the components, and in turns they flatten them to stars.
    """
    if larger:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = kept(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "lowest")
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"), F.col("u").alias("centre"))
    if larger:
        moved = moved.where("u > centre")
    else:
        moved = moved.select("u", "v").unionByName(lowest.select("u", F.col("low").alias("v")))
    return moved.select("u", "v").where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in the pairs ``u``, ``v``; a component is its smallest node."""
    current = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        current = kept(_stars(_stars(current, larger=True), larger=False), "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
