"""Tables that are stored in buckets of a shared key, so that joins and groups on it need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Buckets at least, and rows of a bucket: a bucket is sorted by one task.
BUCKETS, ROWS = 16, 2_000_000


def buckets_for(rows: int) -> int:
    """Buckets of a table of so many rows, so that a task's share stays the same when the table grows."""
    return max(BUCKETS, -(-rows // ROWS))


def save(rows: DataFrame, name: str, key: str, sort: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Save rows as a table in the warehouse, bucketed by key and sorted within buckets. Tables that are joined need equal numbers of buckets.

    Rows are dealt to the buckets' tasks first, so that a bucket is one file.
    """
    rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *sort).format("parquet").saveAsTable(name)


def drop(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
