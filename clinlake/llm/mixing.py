"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 64-bit hash of its id. Words are summed by source and leading hash bits; the
bucket in which the running sum crosses a budget is the only one looked into at the next level of
bits, until a bucket holds one hash. Budgets nest: words up to the source's size are the first pass
over it, the words beyond it a second pass, so a document is taken 0, 1 or 2 times. The thresholds
are a few numbers for each source, and the documents are then filtered without sorting.

Nulls: a null text has size 0; a null source is a source, the last; documents with a null id share
one hash. Equal ids are taken together. Very long texts are counted whole. An empty table gives an empty result. Extra columns pass, but
names that begin with `__mix_` are of this module.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm import common

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
#: Bits of the hash that each level of the histogram adds.
BITS = (12, 12, 12, 12, 14)


#: Column for the place of a document among all hashes.
PLACE = "__mix_place"


def word_count(column: str = "text") -> Column:
    return F.expr(f"regexp_count(coalesce(`{column}`, ''), r'{common.WORD}')").cast("bigint")


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words for each source, in order: by weight, at most `most` times its size, the excess reshared by weight.

    The end of the resharing is min(most * size, level * weight) with one level for all sources that are not at
    their limit, which is found in the order of limit over weight.
    """
    cap = np.array(sizes, float) * most
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    left, weight, out = share * float(sum(sizes)), w.sum(), np.zeros(len(sizes))
    for i in np.argsort(cap / w, kind="stable"):
        level = left / weight if weight > 0 else 0.0
        out[i] = min(cap[i], level * w[i])
        left -= out[i]
        weight -= w[i]
    return [float(x) for x in out]


def _place(df: DataFrame) -> DataFrame:
    """A hash in 0 .. 2**62-1 of the id."""
    return df.withColumn(PLACE, F.xxhash64(F.lit(3), F.col("doc_id")).bitwiseAND(F.lit((1 << 62) - 1)))


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= common.MAX_BROADCAST_ROWS else df


def thresholds(rows: DataFrame, budgets: list[tuple]) -> dict[tuple, int]:
    """For each (source, pass, budget) the place below which documents are taken.

    rows: source, size and the place. One level at a time, only the boundary bucket of each source and pass is
    refined; of a last bucket, which holds one hash, the nearer end is chosen. The driver holds one row
    for each source and pass.
    """
    spark = rows.sparkSession
    used, total = 0, sum(BITS)
    edges = [(s, p, b, 0, 0.0, 0.0) for s, p, b in budgets]
    for bits in BITS:
        schema = "e_source string, pass int, budget double, e_prefix bigint, before double"
        edge = _small(spark, [e[:5] for e in edges], schema)
        open_ = _small(spark, sorted({(e[0], e[3]) for e in edges}, key=str), "o_source string, o_prefix bigint")
        hist = (
            rows.select("source", "size", F.shiftright(PLACE, total - used).alias("prefix"), F.shiftright(PLACE, total - used - bits).alias("bucket"))
            .join(open_, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("prefix") == F.col("o_prefix")))
            .groupBy("source", "prefix", "bucket").agg(F.sum("size").alias("words"))
        )
        both = hist.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("prefix") == F.col("e_prefix")))
        # The buckets of one prefix number at most 2**bits, so the running sum is over a bounded group.
        to = F.col("before") + F.sum("words").over(Window.partitionBy("e_source", "pass").orderBy("bucket"))
        run = both.withColumn("to", to)
        first = F.min(F.when(F.col("to") > F.col("budget"), F.struct("bucket", (F.col("to") - F.col("words")).alias("before"), "words")))
        found = {(r.e_source, r["pass"]): r for r in run.groupBy("e_source", "pass").agg(first.alias("f"), F.max("to").alias("to")).collect()}
        nxt = []
        for source, p, budget, prefix, before, inside in edges:
            r = found.get((source, p))
            if r is None:  # nothing in this bucket
                nxt.append((source, p, budget, prefix << bits, before, 0.0))
            elif r.f is None:  # all of it is within the budget
                nxt.append((source, p, budget, (prefix + 1) << bits, float(r.to), 0.0))
            else:
                nxt.append((source, p, budget, r.f.bucket, float(r.f.before), float(r.f.words)))
        edges, used = nxt, used + bits
    return {(s, p): at + (inside > 0 and before + inside - b < b - before) for s, p, b, at, before, inside in edges}


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """The sizes (doc_id, source, size and the place) and, for each source, source_size, target and the places below which it is taken once and twice."""
    sized = common.materialize(_place(docs.select("doc_id", "source", word_count().alias("size"))), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row for each source
    order = sorted(totals, key=lambda r: (r.source is None, (r.source or "").encode()))
    goal = targets([r.n for r in order], weights, share)
    below = thresholds(sized, [(r.source, p, min(t, float(r.n)) if p == 1 else max(0.0, t - r.n)) for r, t in zip(order, goal) for p in (1, 2)])
    rows = [(r.source, r.n, t, below[r.source, 1], below[r.source, 2]) for r, t in zip(order, goal)]
    return sized, _small(docs.sparkSession, rows, "__mix_source string, __mix_size bigint, __mix_target double, __mix_one bigint, __mix_two bigint")


def _copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    copies = (F.col(PLACE) < F.col("__mix_one")).cast("int") + (F.col(PLACE) < F.col("__mix_two")).cast("int")
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("__mix_source"))).withColumn("__mix_copies", copies)


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words, repeats counted) for every document."""
    sized, cuts = plan(docs, **options)
    taken = (F.col("size") * F.col("__mix_copies")).cast("bigint").alias("taken")
    return _copies(sized, cuts).select("doc_id", "source", "size", F.col("__mix_size").alias("source_size"), F.col("__mix_target").alias("target"), taken, F.col("__mix_copies").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, with all their columns, each as often as the mix takes it."""
    _, cuts = plan(docs, **options)
    rows = _copies(_place(docs), cuts).filter("__mix_copies > 0")
    return rows.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*[f"`{c}`" for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
