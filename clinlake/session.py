"""Session defaults: UTC, ANSI, adaptive execution."""

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session for this engine. On a cluster, master and partition counts come from its own settings."""
    builder = SparkSession.builder.appName("clinlake").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
