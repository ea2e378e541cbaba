"""Sinks of two phases, the sparse index, and roll-ups as mergeable states."""

import json
import time

import pytest
from pyspark.sql import functions as F

from clinlake.operators.states import HLL, Rollup, Rollups
from clinlake.plans import queries as plans
from clinlake.sources import adapters, indexed, two_phase
from clinlake.sources.store import Table

DATA = "/root/testdata/sf0.001"
KINDS = "topic string, key string, value string"


def test_two_phases_write_a_batch_once_and_whole(spark, tmp_path):
    spark.dataSource.register(two_phase.TwoPhaseSink)
    sink, checkpoint = str(tmp_path / "sink"), tmp_path / "c"

    def run(rows=(), slow=False):
        if rows:
            spark.createDataFrame(rows, KINDS).write.mode("append").parquet(str(tmp_path / "in"))
        read = spark.readStream.schema(KINDS).parquet(str(tmp_path / "in"))
        read.writeStream.format("two_phase").option("path", sink).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in two_phase.committed(spark, sink, KINDS).collect())

    assert two_phase.committed(spark, sink, KINDS).count() == 0
    one = [("a", "1", "x"), ("b", "2", None)]
    assert run(one) == one
    # As after a crash between the sink's commit and Spark's: the batch runs again and is not written twice.
    last = max((checkpoint / "commits").iterdir(), key=lambda f: f.name)
    for f in (checkpoint / "commits").glob(f"*{last.name}*"):
        f.unlink()
    assert run() == one
    assert run([("c", "3", "z")]) == [*one, ("c", "3", "z")]
    staged = len(list((tmp_path / "sink" / "staged").glob("*.parquet")))
    named = sum(len(json.loads(f.read_text())["files"]) for f in (tmp_path / "sink" / "commits").glob("*.json"))
    assert staged == named and two_phase.vacuum(spark, sink) == 0


def test_an_aborted_batch_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(two_phase.TwoPhaseSink)
    sink = str(tmp_path / "sink")
    spark.createDataFrame([(str(n), str(n), "v") for n in range(200)], KINDS).repartition(4).write.parquet(str(tmp_path / "in"))
    read = spark.readStream.schema(KINDS).parquet(str(tmp_path / "in")).repartition(4)
    broken = read.withColumn("value", F.when(F.col("key") == "77", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    start = lambda rows: rows.writeStream.format("two_phase").option("path", sink).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="broken"):
        start(broken).awaitTermination()
    assert two_phase.committed(spark, sink, KINDS).count() == 0
    time.sleep(1)  # tasks that were still running when the batch failed
    start(read).awaitTermination()
    assert two_phase.committed(spark, sink, KINDS).count() == 200
    two_phase.vacuum(spark, sink)
    assert two_phase.committed(spark, sink, KINDS).count() == 200


def test_writer_messages(tmp_path):
    import pyarrow as pa

    writer = two_phase.TwoPhaseWriter(str(tmp_path), "p")
    batch = pa.record_batch([pa.array(["a", "b"])], names=["topic"])
    assert writer.write(iter([])) == two_phase.Staged(None, 0)
    first, second = writer.write(iter([batch, batch])), writer.write(iter([batch]))
    writer.commit([first, None], 0)
    writer.commit([second], 0)  # the batch was committed: what is staged again goes
    assert [f.name for f in (tmp_path / "staged").iterdir()] == [first.file.split("/")[1]] and first.rows == 4
    writer.abort([first, None], 1)
    assert not list((tmp_path / "staged").iterdir())

    def broken():
        yield batch
        raise OSError

    with pytest.raises(OSError):
        writer.write(broken())
    assert not list((tmp_path / "staged").iterdir())


def test_a_lookup_opens_one_file(spark, tmp_path):
    path = str(tmp_path / "v")
    visits = adapters.visits(spark, DATA).withColumn("n", F.col("visit_id").cast("bigint"))
    visits = visits.unionByName(visits.limit(2).withColumns({"n": F.lit(None).cast("bigint"), "admit_time": F.lit(None).cast("timestamp")}))
    indexed.write(visits, path, "n", "admit_time", ["visit_id"], files=40)
    files = [r[0] for r in spark.read.parquet(f"{path}/index").select("file").collect()]
    assert len(files) > 40
    opened = []
    for key in [r.n for r in visits.filter("n is not null").select("n").limit(12).collect()]:
        got = indexed.lookup(spark, path, "n", key)
        assert [r.n for r in got.collect()] == [key]
        opened.append(len(got.inputFiles()))
    assert set(opened) <= {1, 2} and sum(opened) <= len(opened) + 1  # the least and largest keys of most files hold the key
    spans = spark.read.parquet(f"{path}/index")
    assert spans.filter((F.col("least") <= key) & (F.col("largest") >= key)).count() > 5
    assert indexed.lookup(spark, path, "n", -5).count() == 0
    month = visits.filter(F.col("n") == key).select(F.date_format("admit_time", "yyyyMM")).first()[0]
    assert len(indexed.candidates(spark, path, key, month)) == 1
    text = indexed.month(spark, path, month)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in text


def test_empty_index(spark, tmp_path):
    indexed.write(adapters.visits(spark, DATA).limit(0), str(tmp_path / "v"), "visit_id", "admit_time")
    assert indexed.lookup(spark, str(tmp_path / "v"), "visit_id", "1").count() == 0


@pytest.fixture(scope="module")
def kept(spark):
    return plans._visit_rollups(spark, DATA)


def test_appended_blocks_equal_a_rebuild(spark, kept):
    visits = adapters.visits(spark, DATA)
    for rollup in plans.visit_rollups():
        groups = list(rollup.groups)
        got = {tuple(r[g] for g in groups): r for r in kept.report(groups, sorted(rollup.measures)).collect()} if rollup.name != "monthly" else None
        whole = {tuple(r[g] for g in groups): r for r in rollup.shown(rollup.states(visits)).collect()}
        if got is None:
            kept_states = rollup.states(visits.filter(F.col("visit_id").cast("bigint") % 5 != 4)).count()
            assert kept_states <= len(whole)
            continue
        assert {k: r.visit_count for k, r in got.items()} == {k: r.visit_count for k, r in whole.items()}
        assert all(abs(got[k].patients - r.patients) <= max(1, 5 * 1.04 / 2 ** (HLL / 2) * r.patients) for k, r in whole.items())
    exact = visits.groupBy("dept", "visit_type").agg(F.count_distinct("patient_id").alias("n")).collect()
    near = {(r.dept, r.visit_type): r.patients for r in kept.report(["dept", "visit_type"], ["patients"]).collect()}
    assert all(abs(near[r.dept, r.visit_type] - r.n) <= max(1, 5 * 1.04 / 2 ** (HLL / 2) * r.n) for r in exact)


def test_reports_take_the_smallest_roll_up_that_covers_them(spark, kept):
    assert kept.covering(["dept"], ["visit_count"]) == "overall" and kept.covering(["dept"], ["hours"]) == "monthly"
    assert kept.covering(["dept"], ["visit_count"], ["year_month"]) == "monthly" and kept.covering(["visit_date"], ["patients"]) == "daily"
    with pytest.raises(ValueError):
        kept.covering(["diagnosis"], ["visit_count"])
    assert kept.freshness("monthly") == {"base": 5, "holds": 4, "fresh": False} and kept.freshness("daily")["fresh"]
    visits = adapters.visits(spark, DATA)
    want = {(r.m, r.n) for r in visits.groupBy(F.date_format("admit_time", "yyyy-MM").alias("m")).agg(F.count("*").alias("n")).collect()}
    report = kept.report(["year_month"], ["visit_count"])
    assert {tuple(r) for r in report.collect()} == want  # the block that the roll-up lacks is counted
    read = " ".join(report.inputFiles())
    assert "/rollup/monthly/" in read and "/base/" in read and "/rollup/daily/" not in read and "orders.parquet" not in read
    quartile = kept.report(["dept"], ["hours"], {"visit_type": "inpatient"}, [0.25]).columns
    assert quartile == ["dept", "hours_25"]


def test_catching_up_and_merging_runs(spark, tmp_path):
    rollup = Rollup("r", {"k": "k"}, {"n": "1L"}, {"who": "v"})
    kept = Rollups(Table(spark, str(tmp_path / "t")), [rollup])
    with pytest.raises(ValueError):
        kept.report(["k"], ["n"])
    for b in range(6):
        kept.append(spark.range(10).select((F.col("id") % 2).alias("k"), (F.col("id") + b).alias("v")), None if b < 5 else [])
    assert kept.freshness("r")["fresh"] is False and kept.catch_up("r") == 1 and kept.catch_up("r") == 0
    assert len(kept.table.runs("rollup/r")) < 6 and {tuple(r) for r in kept.report(["k"], ["n", "who"]).collect()} == {(0, 30, 14), (1, 30, 14)}


def test_quantiles_from_states(spark):
    got = plans.latency_states(spark, DATA).collect()
    assert got and all(r.ok_50 and r.ok_95 and r.ok_99 for r in got)


def test_distinct_estimates_are_within_their_error(spark):
    exact = {r.dept: r.patients for r in plans.uniq_exact(spark, DATA).collect()}
    near = {r.dept: r.patients for r in plans.uniq_approx(spark, DATA).collect()}
    assert exact.keys() == near.keys() and all(abs(near[k] - n) <= max(1, 5 * 1.04 / 2 ** (HLL / 2) * n) for k, n in exact.items())
    assert all(r.close for r in plans.uniq_approx_close(spark, DATA).collect())


def test_settings_reach_the_stream(spark):
    got = {r.topic: r for r in plans.stream_settings(spark, DATA).collect()}
    assert set(got) == {"cdc.his.Users", "cdc.all.clients"} and not any(r.shown for r in got.values())


def test_many_topics_are_subscribed(spark):
    """The connector is not here: what it would be asked for."""
    from types import SimpleNamespace

    from clinlake.streaming import apply

    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, kind):
            self.kind = kind
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            return spark.createDataFrame([(bytearray(b"{}"),)], "value binary")

    reader = Reader()
    assert apply.kafka(SimpleNamespace(readStream=reader), "h:1", ["b", "a", "b"]).collect()[0].value == "{}"
    assert reader.kind == "kafka" and reader.options["subscribe"] == "a,b" and reader.options["kafka.isolation.level"] == "read_committed" and reader.options["maxOffsetsPerTrigger"] == 500


def test_a_block_and_its_states_are_written_by_several_tasks(spark, tmp_path):
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are, states would be put into one task
    try:
        kept = Rollups(Table(spark, str(tmp_path)), [Rollup("by_g", {"g": "g"}, {"n": "1L"}, {"ids": "id"})])
        for _ in range(3):
            kept.append(spark.range(0, 4_000, 1, 4).select("id", (F.col("id") % 100).alias("g")))
            for part in ("base", "rollup/by_g"):
                for _, _, path, rows in kept.table.runs(part):
                    files = [f for f in (tmp_path / path).glob("*.parquet")]
                    assert len(files) > 1 and rows == spark.read.parquet(str(tmp_path / path)).count()
        got = kept.report(["g"], ["n", "ids"]).collect()
        assert len(got) == 100 and all(r.n == 120 and r.ids == 40 for r in got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
