"""Streams freed of repeated rows by state that Spark keeps in RocksDB and forgets after a time to live."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECEIVED = "_received_at"


def on_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams outside of the heap, with change logs as checkpoints, so that a checkpoint costs what changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextmanager
def few_visits(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within have no batches without rows, each of which opens and scans the whole state only to forget keys; the next batch
    with rows forgets them. The state's rows are not counted, as each write reads its key for that.

    A key may so be known for one batch longer than its time. Not for streams whose rows come out only after a time has passed.
    """
    names = ("spark.sql.streaming.noDataMicroBatches.enabled", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
    held = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "false")
    try:
        yield
    finally:
        for name, value in held.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def first_only(rows: DataFrame, key: Sequence[str], hours: int = 168, at: str | None = None) -> DataFrame:
    """The first row of every key of a stream; a key is known for so many hours.

    at: the column of the time from which a key ages. Without it that is the time of the micro-batch, which replays keep:
    no row is late then. With it, rows that are older than the newest by more than `hours` are dropped by Spark as late, so it must be a
    time that the receiver stamps. Rows with a null key are one key.
    """
    on_rocksdb(rows.sparkSession)
    held = rows if at else rows.withColumn(RECEIVED, F.current_timestamp())
    out = held.withWatermark(at or RECEIVED, f"{hours} hours").dropDuplicatesWithinWatermark(list(key))
    return out if at else out.drop(RECEIVED)
