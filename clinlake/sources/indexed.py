"""Files by month that are sorted by key, with a sparse index: least and largest key and a Bloom filter for each file.

The filters are bitmaps over hashes of the keys, made by Spark's bitmap functions: a key sets PROBES bits, of BITS for each row of the largest
file, in pieces of 32,768 bits, each a row of the index. A lookup reads the pieces of its bits only, and opens the files that have all of them.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources.store import month_of

#: Bits for each row of the largest file, and bits that a key sets.
BITS, PROBES = 16, 3
PIECE = 32_768


def _probe(key: Column, n: int, bits: int | Column) -> Column:
    """The bit, from 1, of a key's probe in a filter of so many bits."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(n)), F.lit(bits) if isinstance(bits, int) else bits) + 1


def write(rows: DataFrame, path: str, key: str, at: str, sort: Collection[str] = (), files: int | None = None) -> None:
    """Write rows and their index. files: about how many; without it, the session's shuffle partitions. `ym` is the month of `at`."""
    held = rows.withColumn("ym", month_of(at))
    dealt = held.repartitionByRange("ym", key) if files is None else held.repartitionByRange(files, "ym", key)
    dealt.sortWithinPartitions("ym", key, *sort).write.partitionBy("ym").parquet(f"{path}/data")
    held.limit(0).write.parquet(f"{path}/schema")  # an empty table has no files that say it
    spark = rows.sparkSession
    kept = _data(spark, path).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"), F.col("ym").cast("string").alias("ym"))
    ranges = kept.groupBy("file", "ym").agg(F.min("key").alias("least"), F.max("key").alias("largest"), F.count("*").alias("rows"))
    ranges.write.parquet(f"{path}/index")
    most = spark.read.parquet(f"{path}/index").agg(F.coalesce(F.max("rows"), F.lit(1))).first()[0]
    bits = -(-most * BITS // PIECE) * PIECE
    bitmaps = _bits(kept, bits).groupBy("at", F.bitmap_bucket_number("bit").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    pieces = bitmaps.join(spark.read.parquet(f"{path}/index").select("file", F.xxhash64("file").alias("at")), "at").select("file", "piece", "bitmap")
    pieces.withColumn("bits", F.lit(bits)).repartitionByRange("piece").sortWithinPartitions("piece").write.parquet(f"{path}/filter")


def _bits(kept: DataFrame, bits: int) -> DataFrame:
    """The bits of every row as two numbers, as bitmaps are made by a sort: the file by its hash (files of equal hashes would share
    their bits, which loses no key), and the bit."""
    probes = F.array(*[_probe(F.col("key"), n, bits) for n in range(PROBES)])
    return kept.filter("key is not null").select(F.xxhash64("file").alias("at"), F.explode(probes).alias("bit"))


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/data")


def candidates(spark: SparkSession, path: str, value, month: str | None = None) -> list[str]:
    """The files that may hold a key."""
    ranges = spark.read.parquet(f"{path}/index").filter((F.col("least") <= value) & (F.col("largest") >= value))
    if month is not None:
        ranges = ranges.filter(F.col("ym") == month)
    found = spark.read.parquet(f"{path}/filter")
    bits = (first := found.select("bits").first()) and first[0]
    if not bits:
        return []
    places = spark.range(1).select(*[f(_probe(F.lit(value), n, bits)) for n in range(PROBES) for f in (F.bitmap_bucket_number, F.bitmap_bit_position)]).first()
    probes = list(zip(places[::2], places[1::2]))
    byte = lambda p: F.conv(F.hex(F.substring("bitmap", p // 8 + 1, 1)), 16, 10).cast("int")
    hit = F.lit(0)
    for n, (piece, position) in enumerate(probes):
        hit = hit + F.when((F.col("piece") == piece) & (F.shiftright(byte(position), position % 8) % 2 == 1), 1 << n).otherwise(0)
    pieces = found.filter(F.col("piece").isin([p for p, _ in probes])).groupBy("file").agg(F.bit_or(hit).alias("hit"))
    full = pieces.filter(F.col("hit") == (1 << PROBES) - 1)
    return sorted(r.file for r in full.join(ranges, "file").select("file").collect())  # the files of one key


def lookup(spark: SparkSession, path: str, key: str, value, month: str | None = None) -> DataFrame:
    """The rows of a key; only files that may hold it are opened."""
    files = candidates(spark, path, value, month)
    data = _data(spark, path)
    if not files:
        return data.limit(0)
    return spark.read.option("basePath", f"{path}/data").schema(data.schema).parquet(*files).filter(F.col(key) == value)


def month(spark: SparkSession, path: str, ym: str) -> DataFrame:
    """The rows of a month, which are a folder of their own."""
    return _data(spark, path).filter(F.col("ym") == ym)
