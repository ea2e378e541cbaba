"""Connected components by large and small stars, as joins and minimum aggregates.

A node with many neighbours is no hot key: minima are merged where edges are read, and nodes with more than one in 20,000 of the
edges (fewer than 20,000) get theirs by broadcast (`common.keyed_join`).

An edge with a null end is left out; an edge from a node to itself makes no node; repeated edges count once. No edges give
no nodes. Other columns of the edges are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """Point every neighbour of a node at the smallest node around it: larger neighbours, or the node and smaller ones. total: the number of edges."""
    if large:
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        total *= 2
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = common.materialize(around.groupBy(F.col("u").alias("l")).agg(F.min("v").alias("m"), F.count("*").alias("edges")), "lows")
    pointed = common.keyed_join(around, low, [("u", "l")], "edges", total, "inner")
    if large:
        out = pointed.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        out = pointed.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("l").alias("u"), F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node that can be reached.

    The number of rounds grows with the logarithm of the longest chain; each is written to the shared folder.
    """
    now = common.materialize(edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    old = state(now)
    while old[0]:
        half = common.materialize(_star(now, old[0], True), "large")
        now = common.materialize(_star(half, half.count(), False), "stars")
        new = state(now)
        if new == old:
            break
        old = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
