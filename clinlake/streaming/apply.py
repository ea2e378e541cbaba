"""Change streams into keyed tables, once for each change.

A micro-batch is decoded, keyed, freed of changes that the ledger holds, reduced to the last change of each
key, and written as new runs of the targets and buckets that it touches; the states of all targets and the ledger are one
commit. A batch that runs again finds its changes in the ledger and writes nothing.

A key is source, database, table and primary key; its target is the table `ods_` database and table, which is a part of
the state of its own. A change is known by its source, table, operation, keys and position: log file and place with the
row's sequence, or the log sequence number of its database, and the transaction if it is named.

The cost of a batch follows the batch: a run of the ledger names its first and last day, and the runs are read whose days meet those of the
batch; of the state it reads the runs that are put together, by size (`store.to_merge`), so that a row is written again once for each power of the fan-out; large runs are
written by several tasks. Which version of a key is the last is settled on reading.
"""

from __future__ import annotations

import random
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators import changes, versions
from clinlake.sources.store import TASK_ROWS, Table, to_merge

#: Where a change stands: in a log file, or by sequence number. Sources have one or the other.
POSITION = ("binlog_file", "binlog_pos", "lsn", "row_seq")
KEY = ("source_id", "database", "table", "pk")
#: Buckets of a target's state, and how many runs of about one size a bucket may not have.
BUCKETS, FANOUT = 8, 4
#: Rows for which a run gets another task, as long as the session has as many shuffle partitions.
FEW_ROWS = 20_000
#: The same for the ledger, whose runs are narrow in time if they are put together seldom.
LEDGER_FANOUT = 8
NO_DAY = "none"


def keyed(events: DataFrame) -> DataFrame:
    """Events with all columns of the envelope that identify them, their idempotency key, and pk."""
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in changes.ENVELOPE if f.name not in events.columns}
    events = events.withColumns(lacking) if lacking else events
    key = changes.event_key(events)
    return events.withColumn("idempotency_key", key).withColumn("pk", changes.canonical(F.col("primary_keys")))


def target() -> Column:
    return changes.target_table(F.coalesce("database", F.lit("")), F.coalesce("table", F.lit("")))


def bucket_of(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("string")


def _meets(bucket: str, first: str | None, last: str | None, untimed: bool) -> bool:
    """Whether a ledger run can hold a change of these days. A change that comes again has the same time; changes without a time are runs of their own."""
    if bucket == NO_DAY:
        return untimed
    since, _, until = bucket.partition("-")
    return first is not None and since <= last and first <= until


def _merging(table: Table, part: str, counts: Mapping[tuple[str, str], int], fanout: int) -> tuple[set[str], dict[tuple[str, str], int]]:
    """Paths of the runs that are put together with the new rows, and the rows of each (part, bucket) after that, at most."""
    held: dict[tuple[str, str], list] = {}
    for p, b, path, n in table.runs(part):
        held.setdefault((p, b), []).append((path, n))
    paths, sizes = set(), dict(counts)
    for key, n in counts.items():
        mine = to_merge(held.get(key, []), n, fanout)
        paths |= mine
        sizes[key] += sum(rows for path, rows in held.get(key, []) if path in mine)
    return paths, sizes


def _split(spark: SparkSession, sizes: Mapping[tuple[str, str], int], part: Column, bucket: Column, key: Column, rows: int) -> Column:
    """The task of a bucket that writes a row: buckets with many rows have several."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = {f"{p}|{b}": max(-(-n // rows), min(most, -(-n // FEW_ROWS))) for (p, b), n in sizes.items() if n > min(rows, FEW_ROWS)}
    if not tasks:
        return F.lit(0)
    known = F.create_map(*[F.lit(x) for pair in tasks.items() for x in pair])
    return F.pmod(F.xxhash64(key, F.lit(1)), F.coalesce(F.try_element_at(known, F.concat_ws("|", part, bucket)), F.lit(1)))


def _changed(table: Table, fresh: DataFrame, buckets: int, fanout: int, task_rows: int) -> tuple[tuple, set[str], DataFrame]:
    """What a commit adds to the state for changes, the runs that it drops for that, and what is cached until then. Changes may repeat."""
    # Deleted keys stay as tombstones, so that a change that comes late does not revive them.
    last = versions.latest(fresh.select(*KEY, "op_type", *POSITION, F.coalesce("after", "before").alias("image")), KEY, POSITION).cache()
    made = last  # counted first, then written
    counts = {(f"state/{r.t}", r.b): r["count"] for r in last.groupBy(target().alias("t"), bucket_of(buckets).alias("b")).count().collect()}  # targets and buckets of a batch
    old, sizes = _merging(table, "state", counts, fanout)
    if old:
        last = versions.latest(table.read_runs(old).unionByName(last), KEY, POSITION)
    return (last, bucket_of(buckets), target(), _split(table.spark, sizes, F.concat(F.lit("state/"), target()), bucket_of(buckets), F.col("pk"), task_rows), None if old else sizes), old, made


def apply_once(table: Table, events: DataFrame, name: str, batch: int, buckets: int = BUCKETS, deltas: int = FANOUT, task_rows: int = TASK_ROWS) -> bool:
    """Apply a numbered micro-batch of changes that are known to be new, without a ledger; False where it was applied before.

    The number is a mark of the same commit, so a batch that runs again after a crash changes nothing.
    """
    if table.marks.get(name, -1) >= batch:
        return False
    rows = keyed(events).cache()
    try:
        if rows.isEmpty():
            table.commit(marks={name: batch})
        else:
            state, old, made = _changed(table, rows, buckets, deltas, task_rows)
            try:
                table.commit({"state": state}, marks={name: batch}, drop=old)
            finally:
                made.unpersist()
        return True
    finally:
        rows.unpersist()


def apply_batch(table: Table, events: DataFrame, retention_hours: int | None = None, buckets: int = BUCKETS, deltas: int = FANOUT, task_rows: int = TASK_ROWS) -> int:
    """Apply change events of any tables in one commit; returns how many were new. A change older than its key's state stays without effect.

    retention_hours: ledger days that ended so long before the latest change are forgotten. Changes without a time are never forgotten.
    """
    rows = keyed(events).withColumn("day", F.date_format("source_timestamp", "yyyyMMdd")).cache()
    kept = [rows]
    try:
        first, last, untimed = rows.agg(F.min("day"), F.max("day"), F.count_if(F.col("day").isNull()) > 0).first()
        runs = table.runs("ledger")
        ledger = table.read_runs([path for _, b, path, _ in runs if _meets(b, first, last, untimed)])
        fresh = rows if ledger is None else rows.join(ledger.select("idempotency_key"), "idempotency_key", "left_anti").cache()
        # Repeats within the batch go from the ledger's rows only, which are narrow; in the state the last of a key is one anyway.
        seen = fresh.groupBy("idempotency_key").agg(F.min("source_timestamp").alias("applied_at")).cache()
        kept += [fresh, seen]
        counts = {r.timed: r["count"] for r in seen.groupBy(F.col("applied_at").isNotNull().alias("timed")).count().collect()}  # two rows
        if not counts:
            return 0
        state, drop, made = _changed(table, fresh, buckets, deltas, task_rows)
        kept.append(made)
        since = None
        if retention_hours is not None and last is not None:
            newest = fresh.agg(F.max("source_timestamp") - F.make_dt_interval(F.lit(0), F.lit(retention_hours)))
            since = newest.select(F.date_format(newest.columns[0], "yyyyMMdd")).first()[0]
        forgotten = {path for _, b, path, _ in runs if since and b != NO_DAY and b.partition("-")[2] < since}
        sizes, label, known = {}, NO_DAY, set()
        for timed, n in counts.items():
            held = [(path, rows) for _, b, path, rows in runs if (b != NO_DAY) == timed and path not in forgotten]
            mine = to_merge(held, n, LEDGER_FANOUT)
            if timed:
                days = [d for _, b, path, _ in runs if path in mine for d in b.split("-")]
                label = f"{min([first, *days])}-{max([last, *days])}"
            sizes["ledger", label if timed else NO_DAY] = n + sum(rows for path, rows in held if path in mine)
            known |= mine
        day = F.date_format("applied_at", "yyyyMMdd")
        if known:
            seen = seen.unionByName(table.read_runs(known))
        if since:
            seen = seen.filter(F.coalesce(day >= since, F.lit(True)))
        bucket = F.when(day.isNull(), NO_DAY).otherwise(F.lit(label))
        ledger_rows = (seen, bucket, None, _split(table.spark, sizes, F.lit("ledger"), bucket, F.col("idempotency_key"), task_rows), sizes)
        table.commit({"state": state, "ledger": ledger_rows}, drop=drop | known | forgotten)
        return sum(counts.values())
    finally:
        for df in kept:
            df.unpersist()


def current(table: Table, name: str | None = None) -> DataFrame | None:
    """The last version of every key that is not deleted, of one target or of all."""
    state = table.read("state" if name is None else f"state/{name}")
    return None if state is None else versions.latest(state, KEY, POSITION).filter(F.col("op_type") != "DELETE")


def masked(events: DataFrame, fields: Mapping[str, Mapping[str, list[str]]]) -> DataFrame:
    """Events whose images have the fields of their source and table masked; fields by source and table, as `config.masks` gives them."""
    def one(name: str) -> Column:
        out = None
        for source, tables in fields.items():
            for table, columns in tables.items():
                here = (F.col("source_id") == source) & (F.col("table") == table)
                hidden = changes.masked(F.col(name), columns)
                out = F.when(here, hidden) if out is None else out.when(here, hidden)
        return F.col(name) if out is None else out.otherwise(F.col(name))

    return events.withColumns({name: one(name) for name in ("before", "after")})


def stream(lines: DataFrame, table: Table, checkpoint: str, retention_hours: int | None = None, every: str | None = None, masks: Mapping[str, Mapping[str, list[str]]] | None = None):
    """Start a query that applies JSON lines (column value) of any tables. every: an interval such as '1 second', or none to stop when no lines are left.

    masks: fields by source and table that do not reach the state.
    """

    def work(batch: DataFrame, _: int) -> None:
        good = changes.parsed(batch, changes.ENVELOPE).filter("ok").select("event.*")
        apply_batch(table, masked(good, masks or {}), retention_hours)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return lines.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_deduplicated(lines: DataFrame, table: Table, checkpoint: str, hours: int = 168, at: str | None = None, name: str = "stream", every: str | None = None):
    """As stream(), but repeated changes are known by the query's own state (`dedup.first_only`) in place of the ledger."""
    from clinlake.streaming import dedup

    good = keyed(changes.parsed(lines, changes.ENVELOPE).filter("ok").select("event.*"))
    first = dedup.first_only(good, ["idempotency_key"], hours, at)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return first.writeStream.foreachBatch(lambda batch, n: apply_once(table, batch, name, n)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def messages(events: DataFrame, settings: Mapping) -> DataFrame:
    """topic, key, value of events under settings (`config.load`): masked, and routed by source and table, or else by database and table."""
    from clinlake.sources import config

    spark = events.sparkSession
    routes = spark.createDataFrame(config.routes(dict(settings)), "source_id string, table string, topic string, partition_key_field string")
    out = changes.routed(masked(events, config.masks(dict(settings))), routes)
    return out.select("topic", "key", F.to_json(F.struct("op_type", "primary_keys", "before", "after")).alias("value"))


def stream_messages(lines: DataFrame, path: str, checkpoint: str, settings: Mapping, every: str | None = None):
    """Start a query that sends JSON lines (column value) to their topics as the settings say, by a sink whose readers see whole micro-batches."""
    from clinlake.sources import two_phase

    lines.sparkSession.dataSource.register(two_phase.TwoPhaseSink)
    good = changes.parsed(lines, changes.ENVELOPE).filter("ok").select("event.*")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    out = messages(good, settings).writeStream.format("two_phase").option("path", path).option("checkpointLocation", checkpoint)
    return out.trigger(**trigger).start()


def publish(events: DataFrame, topics: Table, source: str, batch: int) -> bool:
    """Write events (topic, key, value) of a source to their topics, all in one commit. Batches are numbered; one that was committed is not written again.

    Readers of the table see whole transactions only; what an aborted one wrote is not named by any commit.
    """
    if topics.marks.get(source, -1) >= batch:
        return False
    topics.commit({"messages": (events.withColumn("txn", F.lit(f"{source}-{batch}")), F.col("topic"))}, marks={source: batch}, sort=("key",))
    return True


def kafka(spark: SparkSession, servers: str, topics: list[str], per_batch: int = 500) -> DataFrame:
    """Committed messages of many topics as text. The connector has to be on the class path."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(sorted(set(topics))))
    rows = source.option("kafka.isolation.level", "read_committed").option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_batch).load()
    return rows.select(F.col("value").cast("string").alias("value"))


@dataclass
class Retry:
    """Exponential waits with a spread; most: attempts, or none for no end."""

    first: float = 1.0
    factor: float = 2.0
    longest: float = 60.0
    spread: float = 0.3
    most: int | None = None

    def wait(self, attempt: int, rng: random.Random | None = None) -> float:
        base = min(self.longest, self.first * self.factor ** min(attempt, 64))
        return base * (1 + (rng or random).uniform(-self.spread, self.spread))

    def again(self, attempt: int) -> bool:
        return self.most is None or attempt < self.most


def supervise(start: Callable[[], None], policy: Retry, sleep: Callable[[float], None]) -> int:
    """Run until it ends without an error; returns how often it failed before."""
    failed = 0
    while True:
        try:
            start()
            return failed
        except Exception:
            if not policy.again(failed + 1):
                raise
            sleep(policy.wait(failed))
            failed += 1


class Supervisor:
    """Several queries at once, each started again after a failure. stop(): no more starts, running ones end within `grace` seconds."""

    def __init__(self, starts: dict[str, Callable], pause: float = 5.0, grace: float = 30.0):
        self.starts, self.pause, self.grace = starts, pause, grace
        self.stopping, self.failures, self.running = threading.Event(), dict.fromkeys(starts, 0), {}
        self.threads = [threading.Thread(target=self._run, args=(name,), daemon=True) for name in starts]

    def _run(self, name: str) -> None:
        while not self.stopping.is_set():
            try:
                self.running[name] = query = self.starts[name]()
                query.awaitTermination()
                return
            except Exception:
                self.failures[name] += 1
                self.stopping.wait(self.pause)

    def start(self) -> Supervisor:
        for t in self.threads:
            t.start()
        return self

    def join(self) -> None:
        for t in self.threads:
            t.join()

    def stop(self) -> bool:
        """Whether all have ended in time."""
        self.stopping.set()
        for query in list(self.running.values()):
            query.stop()
        for t in self.threads:
            t.join(self.grace)
        return not any(t.is_alive() for t in self.threads)


def recovery_plan(table: Table) -> dict:
    """A fresh start, or a resumption at a version; after a resumption, repeated changes are expected."""
    now = table.version
    return {"fresh": now == 0, "version": now, "may_repeat": now > 0}
