"""Sharding by sampled splitters, with DataFrame functions only.

A record's key is the hash of its text, then the hash of its id and text, then a number of the row, so that equal
texts stand together but a large group of them, or of repeated rows, can be cut. A size-weighted sample of keys gives quantile splitters for many
ranges; the exact bytes of each range are counted, and the ranges in which a shard boundary falls are
overfull and subdivided by splitters sampled within them. Shards are then runs of whole ranges whose
bytes come nearest to equal. Law: `bytes`.

Within a shard, slots are numbered through slices that grow in number with the rows, so that no task
orders a whole shard.

Nulls: a null text has no bytes; a null doc_id is an id like others. Repeated rows are records of their own. Very long
texts are records like others; none is cut. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm import common

SHARDS = 24
#: Bytes that a record takes besides its text.
OVERHEAD = 8
#: First-level ranges for each shard, ranges in each subdivided one, expected sampled keys for each range.
RANGES, SUBRANGES, KEYS = 16, 64, 16
#: Rows in one slice of a shard.
SLICE_ROWS = 20_000


def _draw(rows: DataFrame, expected: Column, seed: int) -> DataFrame:
    """Keys drawn with the expected number of draws for each row (1 at most); one stands for `weight` bytes."""
    chance = F.least(F.lit(1.0), expected)
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(unit < chance).withColumn("weight", F.col("size") / chance)


def _splitters(sample: list, n: int) -> list[str]:
    """At most n - 1 keys that cut the sampled weight into equal parts."""
    rows = sorted((r.key, r.weight) for r in sample)
    step, run, out = sum(w for _, w in rows) / n, 0.0, []
    for key, weight in rows:
        run += weight
        while len(out) < n - 1 and run >= step * (len(out) + 1):
            out.append(key)
    return sorted(set(out))


def _search(keys: list[str], width: int = 20) -> Column:
    """How many splitters are below the key of a row: first in steps of `width`, then within a step."""
    if not keys:
        return F.lit(0)
    every = F.lit(keys)
    if len(keys) < width:
        return F.size(F.filter(every, lambda k: k < F.col("key")))
    steps = F.size(F.filter(F.lit(keys[width - 1 :: width]), lambda k: k < F.col("key")))
    return steps * width + F.size(F.filter(F.slice(every, steps * width + 1, F.lit(width)), lambda k: k < F.col("key")))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, key of every row, kept in the shared folder."""
    digits = lambda h: F.lpad(F.hex(h), 16, "0")
    return common.materialize(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(common.text_of().cast("binary")).cast("bigint").alias("text_crc32"),
            F.concat(digits(F.xxhash64(common.text_of())), digits(F.xxhash64(F.lit(11), F.col("doc_id"), common.text_of())), digits(F.monotonically_increasing_id())).alias("key"),
        ),
        "measured",
    )


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    rows = measure(docs)
    spark = docs.sparkSession
    count, total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    # The number of sampled keys is fixed by the number of ranges, so the driver holds few of them.
    wanted = F.col("size") * (RANGES * shards * KEYS / max(1, total))
    ranged = rows.withColumn("range", _search(_splitters(_draw(rows, wanted, 1).select("key", "weight").collect(), RANGES * shards)).cast("int"))
    filled = sorted((r["range"], r.b) for r in ranged.groupBy("range").agg(F.sum("size").alias("b")).collect())
    ideal = [total * k / shards for k in range(1, shards)]
    overfull, before = [], 0  # ranges that hold a shard boundary
    for at, size in filled:
        if any(before < x < before + size for x in ideal):
            overfull.append((at, SUBRANGES * KEYS / max(1, size)))
        before += size
    # Fewer ranges than shards, so this table is broadcast.
    share = F.broadcast(spark.createDataFrame(overfull, "s_range int, share double"))
    inside = ranged.join(share, F.col("range") == F.col("s_range"))
    sample: dict[int, list] = {}
    for r in _draw(inside, F.col("size") * F.col("share"), 2).select("range", "key", "weight").collect():
        sample.setdefault(r["range"], []).append(r)
    cuts = F.broadcast(spark.createDataFrame([(at, _splitters(x, SUBRANGES)) for at, x in sorted(sample.items())], "s_range int, cuts array<string>"))
    sub = F.coalesce(F.size(F.filter("cuts", lambda k: k < F.col("key"))), F.lit(0))
    split = ranged.join(cuts, F.col("range") == F.col("s_range"), "left").withColumn("part", F.col("range") * SUBRANGES + F.greatest(sub, F.lit(0)))
    parts = sorted((r["part"], r.b) for r in split.groupBy("part").agg(F.sum("size").alias("b")).collect())
    first, before, k = [], 0, 0  # the first part of each shard but shard 0, by the running bytes nearest to its ideal
    for part, size in parts:
        while k < len(ideal) and before + size > ideal[k]:
            first.append(part if ideal[k] - before <= before + size - ideal[k] else part + 1)
            k += 1
        before += size
    which = F.size(F.filter(F.lit(first), lambda x: x <= F.col("part"))) if first else F.lit(0)
    placed = split.select("doc_id", "size", "text_crc32", "key", which.cast("int").alias("shard"))
    return _slots(placed, count, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def _slots(placed: DataFrame, count: int, shards: int) -> DataFrame:
    """Number the rows of every shard from 0, slice by slice. Slices are by hash of the key; their number grows with the rows."""
    slices = max(8, math.ceil(count / (shards * SLICE_ROWS)))
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices)).cast("int"))
    held = placed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "slice", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"))
    numbered = placed.withColumn("at", F.row_number().over(Window.partitionBy("shard", "slice").orderBy("key")) - 1)
    return numbered.join(common.checked_broadcast(starts), ["shard", "slice"]).withColumn("slot", F.col("start") + F.col("at"))


def query(spark, sf_dir: str) -> DataFrame:
    return shard(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
