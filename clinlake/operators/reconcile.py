"""Reconciliation of two tables by hash trees.

A table's leaves are ranges of hashed keys, each with the number of its rows and the sum of their hashes; a node above has the sums
of its children. Trees are compared from the root, and only unequal nodes are opened, so equal tables cost one pass that shuffles a row
for each leaf and task, and of others only the rows of unequal leaves are compared as rows. A tree may be kept (it is small and grows by
adding), so that the next comparison reads no equal data at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a level, and levels: 65,536 leaves.
BITS, LEVELS = 4, 4


def _leaf(keys: Sequence[str]):
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - BITS * LEVELS).cast("int")


def tree(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(leaf, n, digest) of the leaves that have rows. Trees of disjoint rows may be added leaf by leaf."""
    whole = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
    return rows.groupBy(_leaf(keys).alias("leaf")).agg(F.count("*").alias("n"), F.sum(whole).alias("digest"))


def added(*trees: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, trees).groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest"))


def _unequal(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    sides = left.withColumn("sign", F.lit(1)).unionByName(right.withColumn("sign", F.lit(-1)))
    sums = sides.groupBy(key).agg(F.sum(F.col("sign") * F.col("n")).alias("dn"), F.sum(F.col("sign") * F.col("digest")).alias("dd"))
    return sums.filter((F.col("dn") != 0) | (F.col("dd") != 0)).select(key)


def unequal_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """The leaves in which two trees differ, found from the root."""
    open_ = None
    for level in range(1, LEVELS + 1):
        node = F.shiftright("leaf", BITS * (LEVELS - level)).alias("node")
        sides = []
        for side in (left, right):
            held = side if open_ is None else side.join(F.broadcast(open_), F.shiftright("leaf", BITS * (LEVELS - level + 1)) == F.col("above"), "left_semi")  # 2**(BITS * LEVELS) rows at most
            sides.append(held.groupBy(node).agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")))
        open_ = _unequal(*sides, "node").withColumnRenamed("node", "above")
    return open_.withColumnRenamed("above", "leaf")


def only_left(left: DataFrame, right: DataFrame, keys: Sequence[str], leaves: DataFrame | None = None) -> DataFrame:
    """The rows of left that right lacks, with repetitions, as exceptAll gives them; leaves: those that are known to differ."""
    leaves = unequal_leaves(tree(left, keys), tree(right, keys)) if leaves is None else leaves
    near = lambda rows: rows.join(F.broadcast(leaves), _leaf(keys) == F.col("leaf"), "left_semi")
    return near(left).exceptAll(near(right).select(*left.columns))
