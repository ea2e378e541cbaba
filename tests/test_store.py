"""Commits that crash at any step, micro-batches that touch few files, watermarks, offsets, layouts."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from clinlake.functions import fhir
from clinlake.operators import changes, identity
from clinlake.operators.cache import KnownKeys, LocalCache, NotFound, Remote, ResultCache
from clinlake.plans import queries as plans
from clinlake.sources import adapters, binlog, config, generator, olap
from clinlake.sources.store import Conflict, Offsets, Table, write_monthly
from clinlake.streaming import apply, metrics

DATA = "/root/testdata/sf0.001"
SCHEMA = "source_id string, table string, op_type string, primary_keys map<string,string>, before map<string,string>, after map<string,string>, binlog_file string, binlog_pos bigint, row_seq int, source_timestamp timestamp"


class Crash(Exception):
    pass


def crashing(at):
    """Fails after the step of this number."""
    seen = []

    def after(step):
        seen.append(step)
        if len(seen) == at:
            raise Crash(step)

    return after


def log(spark, rows):
    return spark.createDataFrame([("s", "t", op, {"id": pk}, None if op != "DELETE" else {"v": v}, None if op == "DELETE" else {"v": v}, "f1", pos, 0, None) for op, pk, v, pos in rows], SCHEMA).withColumn("source_timestamp", F.timestamp_seconds(F.col("binlog_pos") * 40_000))


def state(table):
    found = apply.current(table)
    return {} if found is None else {r.pk: r.image["v"] for r in found.collect()}


def test_a_crash_at_any_step_loses_and_repeats_nothing(spark, tmp_path):
    one, two = [("INSERT", "1", "a", 1), ("INSERT", "2", "b", 2)], [("UPDATE", "1", "c", 3), ("DELETE", "2", "b", 4)]
    want = {'{"id":"1"}': "c"}
    for at in range(1, 9):
        path = str(tmp_path / f"crash{at}")
        assert apply.apply_batch(Table(spark, path), log(spark, one)) == 2
        try:
            apply.apply_batch(Table(spark, path, crashing(at)), log(spark, two))
            crashed = False
        except Crash:
            crashed = True
        table = Table(spark, path)
        assert table.version in (1, 2) and state(table) in ({'{"id":"1"}': "a", '{"id":"2"}': "b"}, want)
        left = 2 if table.version == 1 else 0
        assert apply.apply_batch(table, log(spark, two)) == left
        assert state(Table(spark, path)) == want and Table(spark, path).read("ledger").count() == 4
        if not crashed:
            break
        Table(spark, path).vacuum()
        assert state(Table(spark, path)) == want
    assert not crashed and at > 3


def test_two_writers_cannot_both_win(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    rows = spark.range(3).withColumn("b", F.lit("x"))
    table.commit({"p": (rows, F.col("b"))})
    other = Table(spark, str(tmp_path / "t"))
    other.folder.after = lambda step: table.commit({"p": (rows, F.col("b"))}) if step.startswith("data") else None
    with pytest.raises(Conflict):
        other.commit({"p": (rows, F.col("b"))})
    assert table.version == 2 and table.read("p").count() == 6


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    apply.apply_batch(table, log(spark, [("INSERT", str(i), "a", i) for i in range(1, 60)]), buckets=8)
    before = {tuple(f) for f in table.files("state")}
    ledger = {tuple(f) for f in table.files("ledger")}
    for k in range(3):
        apply.apply_batch(table, log(spark, [("UPDATE", "7", f"v{k}", 100 + k)]), buckets=8, deltas=3)
        assert ledger < {tuple(f) for f in table.files("ledger")}
    after = {tuple(f) for f in table.files("state")}
    bucket = {b for _, b in after - before}
    assert len(bucket) == 1 and {f for f in before if f[1] not in bucket} == {f for f in after if f[1] not in bucket}
    assert len([f for f in after if f[1] in bucket]) < 4  # its files were put together once
    assert state(table)['{"id":"7"}'] == "v2" and len(state(table)) == 59


def test_retention_forgets_old_days_but_no_change_without_a_time(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    apply.apply_batch(table, log(spark, [("INSERT", "1", "a", 1), ("INSERT", "2", "a", 2)]).withColumn("source_timestamp", F.when(F.col("binlog_pos") == 1, F.lit("2024-01-01 10:00:00").cast("timestamp"))))
    apply.apply_batch(table, log(spark, [("INSERT", "3", "a", 3)]).withColumn("source_timestamp", F.lit(None).cast("timestamp")), retention_hours=24)
    assert table.read("ledger").count() == 3
    apply.apply_batch(table, log(spark, [("INSERT", "4", "a", 4)]).withColumn("source_timestamp", F.lit("2024-02-01 10:00:00").cast("timestamp")), retention_hours=24)
    assert sorted(r.applied_at is None for r in table.read("ledger").collect()) == [False, True, True]


def ods(spark, n):
    made = generator.rows(spark, "visits", n).select(*[F.col(c).cast("string").alias(c) for c in ("visit_id", "patient_id", "dept", "doctor", "visit_type", "admit_time", "diagnosis")])
    same = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("visit_id").cast("int").cast("bigint") % 3)
    return made.withColumns({"_cdc_source_id": F.lit("s"), "_cdc_op_type": F.lit("INSERT"), "_cdc_updated_at": same})


def test_sync_with_equal_times_and_crashes(spark, tmp_path):
    source, path = ods(spark, 50), str(tmp_path / "olap")
    for at in (1, 2, 3, 2, 1):
        try:
            olap.sync(source, Table(spark, path, crashing(at)), "fact_visits", 20)
        except Crash:
            pass
    while olap.sync(source, Table(spark, path), "fact_visits", 20):
        pass
    got = Table(spark, path).read("fact_visits")
    assert got.count() == 50 and got.select("visit_id").distinct().count() == 50
    assert dict(got.dtypes)["admit_time"] == "timestamp" and dict(got.dtypes)["discharge_time"] == "timestamp"
    months = {b for _, b in Table(spark, path).files("fact_visits")}
    one = Table(spark, path).read("fact_visits", {sorted(months)[0]})
    assert {r[0] for r in one.select(F.date_format("admit_time", "yyyyMM")).distinct().collect()} == {sorted(months)[0]}
    assert olap.typed(spark.createDataFrame([("1", "junk", "t", "")], "result_id string, value string, is_abnormal string, result_time string"), "fact_lab_results").select("value", "is_abnormal", "result_time").first() == (None, 1, None)


def test_offsets(spark, tmp_path):
    offsets = Offsets(spark, str(tmp_path / "o"))
    assert offsets.load("a") is None and offsets.sources() == []
    offsets.save("a", {"file": "mysql-bin.000001", "pos": 5678}, "t1")
    offsets.save("a", {"file": "mysql-bin.000002", "pos": 200})
    offsets.save("b", {"lsn": "0x0000002A000001E80003"})
    offsets.save("c", {"file": "mysql-bin.000001", "pos": 0})
    assert offsets.load("a")["pos"] == 200 and offsets.load("b") and offsets.load("c") is None
    assert offsets.sources() == ["a", "b", "c"] and offsets.last_txn("a") == "t1" and len(offsets.history("a")) == 2
    offsets.reset("a")
    assert offsets.load("a") is None and len(offsets.history("a")) == 3


def test_transactions_are_written_once_and_whole(spark, tmp_path):
    events = spark.createDataFrame([("cdc.a", "1", "x"), ("cdc.b", "2", "y")], "topic string, key string, value string")
    with pytest.raises(Crash):
        apply.publish(events, Table(spark, str(tmp_path / "t"), crashing(1)), "s", 0)
    topics = Table(spark, str(tmp_path / "t"))
    assert topics.read("messages") is None
    assert apply.publish(events, topics, "s", 0) and not apply.publish(events, topics, "s", 0) and apply.publish(events, topics, "s", 1)
    assert topics.read("messages", {"cdc.a"}).count() == 2


def test_binlog_stream(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    line = lambda table, op, rows: json.dumps({"database": "his", "table": table, "op_type": op, "keys": ["id"], "rows": rows, "ts": "2024-01-01T00:00:00+00:00"}) + "\n"
    (folder / "bin.000001").write_text(line("patients", "INSERT", [{"id": 1, "v": "a"}]) + line("other", "INSERT", [{"id": 9}]) + "no json\n")
    (folder / "bin.000002").write_text(line("patients", "UPDATE", [{"id": 1, "v": "a"}, {"id": 1, "v": "b"}, {"id": 2, "v": "x"}, {"id": 2, "v": "y"}]) + '{"database": "his", "tab')
    spark.dataSource.register(binlog.BinlogSource)

    def run():
        read = spark.readStream.format("binlog").option("path", str(folder)).option("include", r"his\.patients").option("startingPosition", "earliest").load()
        changes.from_row_events(read).writeStream.option("checkpointLocation", str(tmp_path / "c")).format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.op_type, r.primary_keys["id"], (r.before or {}).get("v"), (r.after or {}).get("v"), r.row_seq) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = [("INSERT", "1", None, "a", 0), ("UPDATE", "1", "a", "b", 0), ("UPDATE", "2", "x", "y", 1)]
    assert run() == first
    with open(folder / "bin.000002", "a") as file:
        file.write('le": "patients", "op_type": "DELETE", "keys": ["id"], "rows": [{"id": 2, "v": "y"}], "ts": null}\n')
    assert run() == [("DELETE", "2", "y", None, 0), *first]
    reader = binlog.BinlogReader({"path": str(folder)})
    assert reader.initialOffset() == reader.latestOffset() and reader.partitions(reader.latestOffset(), reader.latestOffset()) == []


def test_row_events_without_a_pair(spark):
    rows = spark.createDataFrame([("UPDATE", ["id"], [{"id": "1"}]), ("UPDATE", ["id"], [{"id": "1"}, {"id": "2"}, {"id": "3"}])], "op_type string, keys array<string>, rows array<map<string,string>>")
    assert [(r.before["id"], r.after["id"]) for r in changes.from_row_events(rows).collect()] == [("1", "2")]
    assert changes.guessed_key(["name", "visit_id", "a_id"]) == ["a_id", "visit_id"] and changes.guessed_key(["id", "x_id"]) == ["id"] and changes.guessed_key(["b", "a"]) == ["a", "b"]
    ids = changes.with_event_id(spark.range(10)).select("event_id").distinct().count()
    assert ids == 10


def test_keys_and_texts(spark):
    row = spark.createDataFrame([({"b": "2", "a": "1"}, b"\xe5\x86\x85")], "keys map<string,string>, raw binary")
    got = row.select(changes.partition_key(F.col("keys"), "b").alias("b"), changes.partition_key(F.col("keys"), "none").alias("n"), changes.as_text(F.col("raw"), "binary").alias("t")).first()
    assert tuple(got) == ("2", "1", "内")


def test_config(tmp_path):
    (tmp_path / "s.yaml").write_text("sources:\n  - id: his\n    host: ${HOST}\n    mask_fields:\n      patients: [id_card, phone]\npipeline:\n  batch_size: 100\n")
    (tmp_path / "t.json").write_text(json.dumps({"topics": [{"source_id": "his", "table": "visits", "topic": "cdc.v", "partition_key_field": "visit_id"}, {"source_id": "lis", "table": "x", "topic": "cdc.v"}]}))
    got = config.load(str(tmp_path / "s.yaml"), str(tmp_path / "t.json"), env={"HOST": "db1", "CDC_PIPELINE_MAX_RETRIES": "3"})
    assert got["sources"][0]["host"] == "db1" and got["pipeline"]["batch_size"] == 100 and got["pipeline"]["max_retries"] == 3 and got["sink"]["dedup_retention_hours"] == 168
    assert config.masks(got) == {"his": {"patients": ["id_card", "phone"]}} and config.topics(got) == ["cdc.v"] and config.routes(got)[1] == ("lis", "x", "cdc.v", None)


def test_generated_changes(spark):
    got = generator.changes(spark, 20, "insert:2,update:1,delete:1").orderBy("seq").collect()
    assert [r.op_type for r in got[:4]] == ["INSERT", "INSERT", "UPDATE", "DELETE"] and len(got) == 20
    assert [len(r.rows) for r in got[:4]] == [1, 1, 2, 1] and got[6].rows[1]["patient_id"] == "5" and got[7].rows[0]["patient_id"] == "5"
    assert generator.kinds("") == ["insert"] and generator.kinds("x:a") == ["insert"]


def test_remote_errors_are_misses_and_unknown_keys_are_refused(spark):
    class Down:
        def get(self, key):
            raise OSError

        set = delete = get

    remote = Remote(Down())
    keys = spark.range(5000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("k"))
    known = KnownKeys(keys, "k", 5000, 0.01)
    cache = ResultCache(LocalCache(), remote, known)
    assert cache.get("p7", lambda: b"v") == b"v" and remote.errors == 2
    assert all(known(f"p{i}") for i in range(5000)) and sum(known(f"q{i}") for i in range(5000)) < 150
    unknown = next(f"q{i}" for i in range(100) if not known(f"q{i}"))
    with pytest.raises(NotFound):
        cache.get(unknown, lambda: b"")
    known.add(unknown)
    assert cache.get(unknown, lambda: b"new") == b"new"


def test_metrics_and_supervisor(spark, tmp_path):
    progress = metrics.Progress()
    spark.streams.addListener(progress)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    failed = []

    def start():
        if not failed:
            failed.append(1)
            raise OSError
        return spark.readStream.text(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    runner = apply.Supervisor({"one": start}, pause=0.01).start()
    runner.join()
    deadline = time.time() + 20
    with progress.changed:
        while not progress.ended and time.time() < deadline:
            progress.changed.wait(1)
    spark.streams.removeListener(progress)
    assert runner.failures == {"one": 1} and sum(progress.rows.values()) == 2 and list(progress.ended.values()) == [None]
    running = apply.Supervisor({"two": lambda: spark.readStream.format("rate").load().writeStream.format("noop").start()}).start()
    while "two" not in running.running:
        time.sleep(0.05)
    assert running.stop()
    rows, seen = metrics.observed(spark.createDataFrame([("INSERT",), ("DELETE",), ("INSERT",)], "op_type string"), "ops")
    rows.count()
    assert seen.get == {"events": 3, "insert": 2, "update": 0, "delete": 1}


def test_timed_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = apply.stream(spark.readStream.text(str(tmp_path / "in")), Table(spark, str(tmp_path / "s")), str(tmp_path / "c"), every="1 second")
    assert query.isActive
    query.stop()


def test_rules_as_files(spark, tmp_path):
    made, other = fhir.Registry(), fhir.Registry()
    made.update("Patient", [("id", "direct", "patient_id", "toString"), ("gender", "mapping", "gender", ({"M": "male"}, "unknown"))])
    made.save(str(tmp_path / "rules"))
    assert (tmp_path / "rules" / "medication_request.json").exists()
    other.load(str(tmp_path / "rules"))
    assert other.rules == made.rules
    (tmp_path / "rules" / "patient.json").write_text(json.dumps({"resourceType": "Patient", "mappingRules": [{"fhirPath": "id", "type": "magic", "sourceField": None, "detail": None}]}))
    with pytest.raises(ValueError):
        other.load(str(tmp_path / "rules"))
    assert other.rules == made.rules


def test_fuzzy_against_all_pairs(spark):
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(0, 5)))
    people = [(f"e{i}", name(), rng.choice("MF"), str(rng.randint(1, 40))) for i in range(80)]
    asked = [(f"q{i}", name(), rng.choice("MF"), str(rng.randint(1, 60))) for i in range(40)]
    want = set()
    for q, n, g, b in asked:
        for e, pn, pg, pb in people:
            # An empty name counts as a missing one: it equals none and is inside none.
            score = (0 if not n or not pn else 4 if n == pn else 2 if (n in pn or pn in n) else 0) + 2 * (g == pg) + 4 * (b == pb)
            if score >= 4:
                want.add((q, e, score))
    got = identity.fuzzy(spark.createDataFrame(asked, "query_id string, q_name string, q_gender string, q_birth string"), spark.createDataFrame(people, "empi_id string, name string, gender string, birth_date string"))
    assert {tuple(r) for r in got.collect()} == want


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    assert "EqualTo(c_custkey,77)" in plan(plans.lookup_patient(spark, DATA))
    assert "EqualTo(o_orderkey,77)" in plan(plans.lookup_visit(spark, DATA))
    month = plan(plans.partition_pruned_month(spark, DATA))
    assert "GreaterThanOrEqual(o_orderdate" in month and "LessThan(o_orderdate" in month
    counts = plan(plans.latest_version_orders(spark, DATA))
    assert "p_name" not in counts and "part.parquet" not in plan(plans.duplicate_pks(spark, DATA))
    visits = adapters.visits(spark, DATA)
    write_monthly(visits, str(tmp_path / "visits"), "admit_time", ["dept", "admit_time", "visit_id"])
    pruned = spark.read.parquet(str(tmp_path / "visits")).filter("ym = 199703").groupBy("dept").count()
    assert "PartitionFilters: [isnotnull(ym" in plan(pruned)
    assert {tuple(r) for r in pruned.collect()} == {tuple(r) for r in plans.partition_pruned_month(spark, DATA).collect()}


def test_rollup_aggregates_touched_groups_only(spark):
    from clinlake.operators import rollups

    base = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, 3)], "k string, sub string, v int")
    build = lambda df: df.groupBy("k", "sub").agg(F.count("*").alias("n"))
    after = base.unionByName(spark.createDataFrame([("c", "y", 1)], "k string, sub string, v int"))
    got = rollups.incremental(build(base), after, spark.createDataFrame([("c", "y")], "k string, sub string"), ["k", "sub"], build)
    assert {tuple(r) for r in got.collect()} == {("a", None, 1), ("a", "x", 1), ("b", None, 1), ("c", "y", 1)}
    text = got._jdf.queryExecution().optimizedPlan().toString()
    above = text[: text.index("LeftSemi")].rsplit("Aggregate", 1)[1]
    assert "count(1) AS n" in above  # the join with touched groups is below the aggregate
