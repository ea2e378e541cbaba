"""Many targets in one commit, state put together by size, log sequence numbers, streams with state, zones and empty values."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from clinlake.functions import fhir
from clinlake.operators import changes, identity
from clinlake.plans import queries as plans
from clinlake.sources import adapters
from clinlake.sources.store import CHECKPOINT, Table, to_merge
from clinlake.streaming import apply, dedup

DATA = "/root/testdata/sf0.001"
SCHEMA = (
    "source_id string, database string, table string, op_type string, primary_keys map<string,string>, before map<string,string>, after map<string,string>, "
    "binlog_file string, binlog_pos bigint, row_seq int, lsn string, txn_id string, source_timestamp timestamp"
)


def event(table, op, pk, v, pos=None, lsn=None, txn=None, source="s", database="his"):
    image = {"id": pk, "v": v}
    return (source, database, table, op, {"id": pk}, image if op == "DELETE" else None, None if op == "DELETE" else image, None if pos is None else "f1", pos, 0, lsn, txn, None)


def values(table, name=None):
    found = apply.current(table, name)
    return {} if found is None else {(r.source_id, r.database, r.table, r.pk): r.image["v"] for r in found.collect()}


def test_tables_with_equal_keys_do_not_meet(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    rows = [event("patients", "INSERT", "1", "p", 1), event("visits", "INSERT", "1", "v", 2), event("Visits", "INSERT", "1", "w", 3, database="lis"), event("visits", "INSERT", "1", "o", 4, source="other")]
    assert apply.apply_batch(table, spark.createDataFrame(rows, SCHEMA)) == 4 and table.version == 1
    assert table.parts("state") == ["state/ods_his_patients", "state/ods_his_visits", "state/ods_lis_visits"]
    assert sorted(values(table).values()) == ["o", "p", "v", "w"]
    assert {k[0] for k in values(table, "ods_his_visits")} == {"s", "other"} and list(values(table, "ods_lis_visits").values()) == ["w"]
    apply.apply_batch(table, spark.createDataFrame([event("visits", "DELETE", "1", "v", 5)], SCHEMA))
    assert sorted(values(table).values()) == ["o", "p", "w"]


def test_log_sequence_numbers_tell_changes_apart_and_order_them(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    one, two = event("t", "UPDATE", "1", "a", lsn="0A"), event("t", "UPDATE", "1", "b", lsn="0B")
    assert apply.apply_batch(table, spark.createDataFrame([two], SCHEMA)) == 1
    assert apply.apply_batch(table, spark.createDataFrame([one, two, one], SCHEMA)) == 1
    assert list(values(table).values()) == ["b"]
    keys = [r[0] for r in spark.createDataFrame([one, event("t", "UPDATE", "1", "a", lsn="0A", txn="7"), event("t", "UPDATE", "1", "a", lsn="0A", database="lis"), two], SCHEMA).select(changes.event_key(apply.keyed(spark.createDataFrame([], SCHEMA)))).collect()]
    assert len(set(keys)) == 4
    plain = spark.createDataFrame([event("t", "UPDATE", "1", "a", 5)], SCHEMA)
    old = changes.idempotency_key(*[F.col(c) for c in ("source_id", "table", "op_type", "primary_keys", "binlog_file", "binlog_pos", "row_seq")])
    assert plain.select(changes.event_key(plain) == old).first()[0]


def test_rows_are_written_again_a_logarithm_of_times(spark, tmp_path):
    """40 batches of 500 new keys: the runs that all commits add hold a few times the rows, and a commit file stays small."""
    path = tmp_path / "t"
    table = Table(spark, str(path))
    log = spark.range(20_000).select(
        F.lit("s").alias("source_id"), F.lit("his").alias("database"), F.lit("t").alias("table"), F.lit("INSERT").alias("op_type"), F.create_map(F.lit("id"), F.col("id").cast("string")).alias("primary_keys"),
        F.lit(None).cast("map<string,string>").alias("before"), F.create_map(F.lit("v"), F.col("id").cast("string")).alias("after"), F.lit("f").alias("binlog_file"), F.col("id").alias("binlog_pos"), F.lit(0).alias("row_seq"),
    )
    fanout, buckets = 4, 1
    for k in range(40):
        assert apply.apply_batch(table, log.filter(F.col("id").between(k * 500, k * 500 + 499)), buckets=buckets, deltas=fanout) == 500
    deltas = [json.loads((path / "commits" / f"{n:012d}.json").read_text()) for n in range(1, 41)]
    for part, wide in (("state/ods_his_t", fanout), ("ledger", apply.LEDGER_FANOUT)):
        written = sum(rows for d in deltas for _, _, rows in d["add"].get(part, []))
        assert 20_000 < written <= 20_000 * (1 + math.ceil(math.log(40, wide))), part
        assert len(table.runs(part)) < buckets * wide * (1 + math.log(40, wide))
        assert sum(n for *_, n in table.runs(part)) == 20_000
    sizes = [(path / "commits" / f"{n:012d}.json").stat().st_size for n in range(1, 41)]
    assert max(sizes[20:]) <= 1.5 * max(sizes[:20])
    assert apply.current(table).count() == 20_000 and apply.apply_batch(table, log.limit(700)) == 0
    # A reader that comes new starts at a checkpoint; without one it replays all.
    fresh = Table(spark, str(path))
    assert fresh.manifest() == table.manifest() and sorted(fresh._numbers("checkpoints")) == [CHECKPOINT, 2 * CHECKPOINT]
    for n in fresh._numbers("checkpoints"):
        fresh.folder.remove(f"checkpoints/{n:012d}.json")
    assert Table(spark, str(path)).manifest() == table.manifest()
    behind = Table(spark, str(path))
    behind._known = (3, behind.manifest(3))  # as of a reader that has seen no commit since
    assert table.vacuum() > 0 and behind.manifest() == table.manifest() and Table(spark, str(path)).manifest()["parts"] == table.manifest()["parts"] and apply.current(Table(spark, str(path))).count() == 20_000


def test_large_runs_are_written_by_several_tasks(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # runs as small as these would be one task again
    try:
        apply.apply_batch(table, adapters.mixed_log(spark, DATA), buckets=1, task_rows=60)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for part, _, path, rows in table.runs("state"):
        files = [f for f in (tmp_path / "t" / path).iterdir() if f.name.startswith("part-")]
        assert rows < 60 or len(files) > 1, part


def test_a_batch_is_brought_to_its_last_changes_once(spark, tmp_path):
    """What is counted is what is written, and images are not carried through a search for repeats."""
    table, seen, commit = Table(spark, str(tmp_path / "t")), [], Table.commit

    def kept(add, **more):
        state = add["state"][0]
        seen.append((state.storageLevel.useMemory, "first(after" in state._jdf.queryExecution().executedPlan().toString()))
        return commit(table, add, **more)

    table.commit = kept
    one = [event("t", "INSERT", str(k % 3), f"v{k}", k) for k in range(6)]
    assert apply.apply_batch(table, spark.createDataFrame(one + one[4:], SCHEMA)) == 6
    assert apply.apply_batch(table, spark.createDataFrame([event("u", "INSERT", "1", "w", 9), *one], SCHEMA)) == 1
    assert seen == [(True, False)] * 2
    assert sorted(values(table).values()) == ["v3", "v4", "v5", "w"] and table.read("ledger").count() == 7


def test_ledger_runs_of_other_days_are_not_read(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    at = lambda day: spark.createDataFrame([event("t", "INSERT", str(day), "v", day)], SCHEMA).withColumn("source_timestamp", F.lit(f"2024-01-{day:02d} 05:00:00").cast("timestamp"))
    for day in (3, 9, 20):
        apply.apply_batch(table, at(day))
    read, runs = [], table.read_runs
    table.read_runs = lambda paths: read.extend(paths) or runs(paths)
    assert apply.apply_batch(table, at(9)) == 0 and len(read) == 1
    read.clear()
    assert apply.apply_batch(table, at(9).unionByName(at(21))) == 1 and len(read) == 2


def test_runs_to_merge():
    rng = random.Random(1)
    held, written, total = [], 0, 0
    for n in range(3_000):
        rows = rng.choice([1, 1, 1, 5, 40])
        taken = to_merge(held, rows, 4)
        merged = rows + sum(r for p, r in held if p in taken)
        held = [(p, r) for p, r in held if p not in taken] + [(str(n), merged)]
        written, total = written + merged, total + rows
        assert len(held) < 4 * (2 + math.log(total + 1, 4))
    assert sum(r for _, r in held) == total and written < total * (2 + math.log(total, 4))


def test_a_crash_leaves_all_targets_or_none(spark, tmp_path):
    class Crash(Exception):
        pass

    one = [event("a", "INSERT", "1", "x", 1), event("b", "INSERT", "1", "y", 2)]
    two = [event("a", "UPDATE", "1", "x2", 3), event("b", "UPDATE", "1", "y2", 4)]
    for at in range(1, 6):
        path, seen = str(tmp_path / f"c{at}"), []
        apply.apply_batch(Table(spark, path), spark.createDataFrame(one, SCHEMA))

        def after(step):
            seen.append(step)
            if len(seen) == at:
                raise Crash

        try:
            apply.apply_batch(Table(spark, path, after), spark.createDataFrame(two, SCHEMA))
        except Crash:
            pass
        assert sorted(values(Table(spark, path)).values()) in (["x", "y"], ["x2", "y2"])
        apply.apply_batch(Table(spark, path), spark.createDataFrame(two, SCHEMA))
        assert sorted(values(Table(spark, path)).values()) == ["x2", "y2"]


def test_numbered_batches_are_applied_once(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([event("a", "INSERT", "1", "x", 1)], SCHEMA)
    assert apply.apply_once(table, rows, "s", 0) and not apply.apply_once(table, rows, "s", 0) and apply.apply_once(table, rows.limit(0), "s", 1)
    assert table.version == 2 and table.marks == {"s": 1} and table.read("ledger") is None


def test_a_stream_with_state_gives_what_the_ledger_gives(spark, tmp_path):
    """Stopped in mid-stream and started again on its checkpoint, with repeated changes on both sides of the stop."""
    ledger, streamed = Table(spark, str(tmp_path / "l")), Table(spark, str(tmp_path / "s"))
    counts = []
    for batch in plans._thirds(adapters.mixed_log(spark, DATA)):
        apply.apply_batch(ledger, batch)
        plans._lines_of(batch).repartition(3).write.mode("append").text(str(tmp_path / "in"))
        query = apply.stream_deduplicated(spark.readStream.text(str(tmp_path / "in")), streamed, str(tmp_path / "c"))
        query.awaitTermination()
        held = [o for p in query.recentProgress for o in p["stateOperators"]]
        counts.append(max(o["numRowsTotal"] for o in held))
        assert any("rocksdb" in name.lower() for o in held for name in o["customMetrics"])
    seen = ledger.read("ledger").count()
    assert counts[0] < counts[1] == seen
    shown = lambda t: sorted((r.target, r.id, r.op_type, r.event) for r in plans._targets(apply.current(t)).collect())
    assert shown(streamed) == shown(ledger) and streamed.read("ledger") is None


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    kinds = "k string, at timestamp"

    def run(rows, n):
        spark.createDataFrame(rows, "k string, at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        first = dedup.first_only(spark.readStream.schema(kinds).parquet(str(tmp_path / "in")), ["k"], hours=24, at="at")
        first.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.k for r in spark.read.schema(kinds).parquet(str(tmp_path / "out")).collect())

    assert run([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01")], 0) == ["a", "b"]
    assert run([("a", "2024-01-01 12:00:00"), ("c", "2024-01-05 00:00:00")], 1) == ["a", "b", "c"]
    assert run([("a", "2024-01-05 01:00:00")], 2) == ["a", "a", "b", "c"]


def test_clicks_have_one_batch_for_each_delivery(spark, tmp_path, monkeypatch):
    """No batch opens the state only to forget keys, and the settings for that do not stay."""
    monkeypatch.setattr(plans, "scratch", lambda s, name: str(tmp_path))
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.noDataMicroBatches.enabled", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")}
    rows = plans.stream_clicks_once(spark, DATA)
    want = spark.read.parquet(f"{DATA}/clicks.parquet").filter("arrived_at is not null").distinct()
    assert rows.count() == want.count() and rows.select("click_id").exceptAll(want.select("click_id")).isEmpty()
    assert sorted(p.name for p in (tmp_path / "checkpoint/commits").iterdir() if p.name.isdigit()) == ["0", "1", "2"]
    assert {k: spark.conf.get(k, None) for k in kept} == kept


def test_masks_of_the_settings_reach_the_stream(spark, tmp_path):
    fields = {"s": {"patients": ["phone"]}, "lis": {"x": ["v"]}}
    rows = [("s", "his", table, "INSERT", {"id": "1"}, None, {"phone": "5", "v": "1"}, "f", pos, 0, None, None, None) for pos, table in enumerate(["patients", "visits"])]
    plans._lines_of(spark.createDataFrame(rows, SCHEMA)).write.text(str(tmp_path / "in"))
    table = Table(spark, str(tmp_path / "t"))
    apply.stream(spark.readStream.text(str(tmp_path / "in")), table, str(tmp_path / "c"), masks=fields).awaitTermination()
    assert {r.table: r.image for r in apply.current(table).collect()} == {"patients": {"phone": "***", "v": "1"}, "visits": {"phone": "5", "v": "1"}}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_times_are_utc_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(1_704_164_645_250_000,), (1_710_055_800_000_000,), (-1_500_000,)], "us bigint").select(F.timestamp_micros("us").alias("at"))
        assert [r[0] for r in rows.select(changes.as_text(F.col("at"), "timestamp")).collect()] == ["2024-01-02T03:04:05.25Z", "2024-03-10T07:30:00Z", "1969-12-31T23:59:58.5Z"]
        made = fhir.to_resource(rows.withColumnRenamed("at", "admit_time"), "Encounter").select("period.start").collect()
        assert [r[0] for r in made] == ["2024-01-02T03:04:05.250Z", "2024-03-10T07:30:00.000Z", "1969-12-31T23:59:58.500Z"]
        for name in ("normalize_time", "normalize_text"):
            got = plans.QUERIES[name](spark, DATA).agg(F.min("at"), F.max("at")).first()
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            assert got == plans.QUERIES[name](spark, DATA).agg(F.min("at"), F.max("at")).first()
            spark.conf.set("spark.sql.session.timeZone", zone)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_values_are_no_match(spark):
    persons = spark.createDataFrame([("e1", "anna", "M", ""), ("e2", "", "F", "1990"), ("e3", "", "M", "1990-01-01"), ("e4", None, None, None)], "empi_id string, name string, gender string, birth_date string")
    asked = spark.createDataFrame([("a", "", "F", "x"), ("b", "", "M", "1990-01-01"), ("c", "anna", "", ""), ("d", None, "M", "")], "query_id string, q_name string, q_gender string, q_birth string")
    assert {(r.query_id, r.empi_id): r.score for r in identity.fuzzy(asked, persons).collect()} == {("b", "e3"): 6, ("c", "e1"): 4}


def test_bundles(spark):
    pages = plans.bundle_pages(spark, DATA, size=3).collect()
    held = {}
    for r in sorted(pages, key=lambda r: r.page):
        made = json.loads(r.bundle)
        assert list(made) == ["resourceType", "type", "total", "timestamp", "entry"] and (made["resourceType"], made["type"], made["total"]) == ("Bundle", "searchset", r.total)
        assert len(made["entry"]) <= 3
        held.setdefault(r.patient_id, []).extend((e["resource"]["id"], e["search"]["mode"]) for e in made["entry"])
    entries = plans.everything_entries(spark, DATA).orderBy("patient_id", "position").collect()
    want = {}
    for e in entries:
        want.setdefault(e.patient_id, []).append((e.id, e.search_mode))
    assert held == want and max(r.page for r in pages) > 1


def test_the_bundle_plan_maps_entries_once(spark):
    text = plans.everything_bundle(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    scans = text.split("+- == Initial Plan ==")[-1].count("FileScan parquet")
    assert scans <= 12  # 24 when totals were a join of their own
    joins = adapters.master_index(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in joins and joins.count("FileScan") == 1
