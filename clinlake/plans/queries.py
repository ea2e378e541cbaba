"""Every operator over the tables of a folder, by name."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinlake.functions import fhir
from clinlake.operators import changes, identity, rollups, versions
from clinlake.sources import adapters as src
from clinlake.sources import generator

AS_OF = "2002-01-01 00:00:00"
ORDER_TIES = ("order_time", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "status")
NOW = "2024-02-01 00:00:00"


def day(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def second(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


_made: list[tuple] = []
_tables: list[tuple] = []


def scratch(s, name: str) -> str:
    """A new folder in the one that all executors share; a temporary one in local mode, as in tests. `release` deletes it."""
    base = s.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not s.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/clinlake-{name}-{uuid.uuid4().hex}"
    _made.append((s, path))
    return path


@contextlib.contextmanager
def shuffles_dropped(s):
    """What is shuffled for tables that are written meanwhile is deleted as each is written, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = s.conf.get(key, None)
    s.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            s.conf.unset(key)
        else:
            s.conf.set(key, was)


def staged(s, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table that is written to a scratch folder and read back, and the folder: the disk holds the shuffles before or after it, not both."""
    path = scratch(s, name)
    with shuffles_dropped(s):
        df.write.option("compression", "zstd").parquet(path)
    return s.read.schema(df.schema).parquet(path), path


def _delete(s, path: str) -> None:
    where = s._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(s._jsc.hadoopConfiguration()).delete(where, True)


def release() -> None:
    """Delete the scratch folders and tables so far; results that read them must have been written before. Called at exit too."""
    while _tables:
        s, name = _tables.pop()
        try:
            s.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session may have ended
            break
    while _made:
        try:
            _delete(*_made.pop())
        except Exception:  # the session may have ended
            return


atexit.register(release)


def _patients(s, d):
    """Patients without each tenth, so that some visits have none."""
    return src.patients(s, d).filter(F.col("patient_id").cast("bigint") % 10 != 0)


def _orders(s, d, columns, drugs=True):
    """Last versions of medication orders. They are shuffled by the numbers of which their ids are made, as these are narrower."""
    ids = {"order_id": src.order_id(), "visit_id": F.col("l_orderkey").cast("string")}
    last = versions.latest(src.medication_versions(s, d, drugs), ["l_orderkey", "l_linenumber"], ORDER_TIES, columns=[c for c in columns if c not in ids])
    return last.select(*[ids[c].alias(c) if c in ids else c for c in ("order_id", *columns)])


def _keyed(s, d):
    log = src.change_log(s, d)
    key = changes.idempotency_key(*[F.col(c) for c in ("source_id", "table", "op_type", "primary_keys", "binlog_file", "binlog_pos", "row_seq")])
    return log.withColumn("idempotency_key", key).withColumn("pk", changes.partition_key(F.col("primary_keys")))


def _visit_versions(s, d, key=None):
    """Visits, and for each seventh a later version in another department."""
    v = src.visits(s, d, key=key).withColumn("version", F.lit(1))
    moved = v.filter(F.col("visit_id").cast("bigint") % 7 == 0).withColumn("dept", F.lit("MOVED")).withColumn("version", F.lit(2))
    return v.unionByName(moved)


def visit_wide(s, d):
    w = rollups.visit_wide(src.visits(s, d), _patients(s, d), at(AS_OF))
    return w.select("visit_id", "patient_id", "patient_name", "gender", "dept", "visit_type", "diagnosis", second("admit_time").alias("admit_time"), F.round("age", 4).alias("age"), "los_hours")


def dept_daily_visits(s, d):
    return rollups.dept_daily(src.visits(s, d)).withColumn("visit_date", day("visit_date"))


def drug_daily_orders(s, d):
    return rollups.drug_daily(_orders(s, d, ["drug_name", "order_time", "status"])).withColumn("order_date", day("order_date"))


def patient_monthly(s, d):
    return rollups.patient_monthly(src.visits(s, d))


def rollup_merge_partials(s, d):
    v = src.visits(s, d).withColumn("block", F.col("visit_id").cast("bigint") % 4)
    parts = v.groupBy("block", day("admit_time").alias("visit_date"), "dept", "visit_type").agg(F.count("*").alias("visit_count"))
    return rollups.merge_partials(parts, ["visit_date", "dept", "visit_type"], ["visit_count"])


def rollup_incremental(s, d):
    keys = ["visit_date", "dept", "visit_type"]
    before = src.visits(s, d)
    moved = F.col("visit_id").cast("bigint") % 100 == 0
    after = before.withColumn("dept", F.when(moved, "MOVED").otherwise(F.col("dept")))
    changed = before.filter(moved).unionByName(after.filter(moved)).withColumn("visit_date", F.to_date("admit_time"))
    return rollups.incremental(rollups.dept_daily(before), after, changed, keys, rollups.dept_daily, {"visit_date": F.to_date("admit_time")}).withColumn("visit_date", day("visit_date"))


def partition_pruned_month(s, d):
    return src.visits(s, d, since="1997-03-01", until="1997-04-01").groupBy("dept").agg(F.count("*").alias("visits"))


def latest_version(s, d):
    return _orders(s, d, ["drug_name", "status", "order_time", "l_partkey", "l_suppkey"]).select("order_id", "drug_name", "status", second("order_time").alias("order_time"), "l_partkey", "l_suppkey")


def latest_version_visits(s, d):
    return versions.latest(_visit_versions(s, d), ["visit_id"], ["version"]).select("visit_id", "dept", "version")


def latest_version_orders(s, d):
    return _orders(s, d, ["visit_id", "status"], drugs=False).groupBy("visit_id").agg(F.count("*").alias("orders"), F.count_if(F.col("status") == "executed").alias("executed"))


def lookup_patient(s, d):
    return src.patients(s, d, key=77).limit(1)


def lookup_visit(s, d):
    return versions.latest(_visit_versions(s, d, key=77), ["visit_id"], ["version"]).limit(1).select("visit_id", "patient_id", "dept", "visit_type", second("admit_time").alias("admit_time"))


def incremental_pull(s, d):
    e = src.table(s, d, "events").withColumn("ts", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    got = changes.incremental(e, "ts", "event_id", (at("2024-01-05 03:00:00"), 40), 200)
    return got.select("event_id", second("ts").alias("ts"), "event_type")


def _text_store(s, d):
    e = src.table(s, d, "events")
    bad = F.col("event_id") % 11 == 0
    return e.select(
        F.col("event_id").cast("string").alias("result_id"), F.when(bad, "").otherwise(F.round("value", 2).cast("decimal(18,2)").cast("string")).alias("value"),
        F.when(F.col("event_id") % 3 == 0, "true").when(F.col("event_id") % 3 == 1, "0").otherwise("junk").alias("is_abnormal"),
        F.when(bad, "not-a-date").otherwise(second(F.col("ts").cast("timestamp"))).alias("result_time"),
    )


def ods_typed_cast(s, d):
    t = _text_store(s, d)
    return t.select(
        "result_id", F.expr("try_cast(value AS decimal(18,2))").cast("double").alias("value"), F.expr("try_cast(is_abnormal AS boolean)").cast("string").alias("is_abnormal"),
        day(F.expr("try_cast(result_time AS timestamp)")).alias("result_day"),
    )


def cdc_envelope(s, d):
    e = src.change_log(s, d)
    return e.select("source_id", "op_type", F.col("primary_keys")["user_id"].alias("pk"), F.col("binlog_pos").alias("pos"), F.col("after")["event"].alias("after_event"), F.col("before")["event"].alias("before_event"))


def _coded(s, d):
    e = src.table(s, d, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("pk"), (F.col("event_id") % 6).alias("op_code"), F.lpad(F.hex(F.expr("event_id div 4")), 20, "0").alias("lsn"), F.col("event_type").alias("image"))


def cdc_decode_op(s, d):
    return _coded(s, d).groupBy(changes.decode_op(F.col("op_code")).alias("op_type")).agg(F.count("*").alias("n"))


def cdc_pair_updates(s, d):
    e = src.table(s, d, "events").select(F.expr("event_id div 2").alias("pk"), F.lpad(F.hex(F.expr("event_id div 2")), 20, "0").alias("lsn"), (3 + F.col("event_id") % 2).alias("op_code"), F.col("event_type").alias("image"))
    return changes.pair_updates(e, ["pk"])


def cdc_poll_range(s, d):
    low, high = f"{16:020X}", f"{900:020X}"
    return changes.polled(_coded(s, d), low, high, 1001, tie=["event_id"]).select("event_id", "lsn", "op_code")


def _lines(s, d):
    e = src.table(s, d, "events")
    good = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("user_id").alias("user")))
    return e.select("event_id", F.when(F.col("event_id") % 10 == 3, "not-json").when(F.col("event_id") % 10 == 7, "{}").otherwise(good).alias("value"))


def _line_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("user", T.LongType())])


def parse_skip_bad_json(s, d):
    got = changes.parsed(_lines(s, d), _line_schema())
    return got.groupBy("ok").agg(F.count("*").alias("lines"), F.coalesce(F.sum("event.user"), F.lit(0)).alias("users"))


def json_roundtrip(s, d):
    got = changes.parsed(_lines(s, d), _line_schema()).filter("ok")
    back = F.from_json(F.to_json("event"), _line_schema())
    return got.select("event_id", back["kind"].alias("kind"), back["user"].cast("string").alias("user"))


def mask_fields(s, d):
    c = src.table(s, d, "customer")
    image = F.create_map(F.lit("name"), F.col("c_name"), F.lit("phone"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey").cast("string")))
    m = changes.masked(image, changes.MASKED["patients"])
    return c.select(F.col("c_custkey").alias("id"), m["name"].alias("name"), m["phone"].alias("phone"))


def normalize_text(s, d):
    o = src.table(s, d, "orders")
    return o.select(changes.as_text(F.col("o_orderkey") * 1000000, "bigint").alias("id"), changes.as_text(F.col("o_orderdate").cast("timestamp_ntz"), "timestamp_ntz").alias("at"), changes.as_text(F.col("o_orderstatus") == "F", "boolean").alias("final"))


def route_topic(s, d):
    e = src.change_log(s, d)
    return e.groupBy(changes.topic(F.col("source_id"), F.lower("table")).alias("topic")).agg(F.count("*").alias("n"))


def route_target_table(s, d):
    e = src.change_log(s, d)
    return e.groupBy(changes.target_table(F.col("database"), F.col("table")).alias("target")).agg(F.count("*").alias("n"))


def partition_key(s, d):
    return _keyed(s, d).groupBy("pk").agg(F.count("*").alias("n"))


def idempotency_key(s, d):
    return _keyed(s, d).select("binlog_pos", "idempotency_key")


def _ledger(s, d):
    k = _keyed(s, d).filter(F.col("binlog_pos") % 3 == 0)
    return k.select("idempotency_key", F.col("source_timestamp").alias("applied_at"))


def dedup_idempotent(s, d):
    twice = _keyed(s, d)
    return versions.unseen(twice.unionByName(twice), _ledger(s, d)).select("binlog_pos", "op_type")


def dedup_retention(s, d):
    return versions.retained(_ledger(s, d), at("2024-01-30 00:00:00")).groupBy(day("applied_at").alias("day")).agg(F.count("*").alias("kept"))


def _state(s, d, upto=None):
    k = _keyed(s, d)
    k = k if upto is None else k.filter(F.col("binlog_pos") <= upto)
    return versions.latest(k, ["pk"], ["binlog_file", "binlog_pos", "row_seq"])


def apply_changes(s, d):
    """The change log in two overlapping halves through a keyed table with its ledger."""
    from clinlake.sources.store import Table
    from clinlake.streaming import apply

    table = Table(s, scratch(s, "apply"))
    log = src.change_log(s, d)
    middle = log.agg(F.expr("percentile_approx(binlog_pos, 0.5)")).first()[0]
    if middle is not None:
        apply.apply_batch(table, log.filter(F.col("binlog_pos") <= middle + 100))
        apply.apply_batch(table, log.filter(F.col("binlog_pos") > middle - 100))
    state = apply.current(table)
    if state is None:
        return _state(s, d).limit(0).select("pk", "op_type", "binlog_pos", F.lit("").alias("event"))
    # The table's key is the JSON of all keys; the result shows the one key that it holds.
    return state.select(F.get_json_object("pk", "$.user_id").alias("pk"), "op_type", "binlog_pos", F.col("image")["event"].alias("event"))


def _thirds(log: DataFrame) -> list[DataFrame]:
    """A log in two batches that overlap and are not in order."""
    third = F.col("n") % 3
    return [log.filter(third != 0), log.filter(third != 1)]


def _targets(state: DataFrame) -> DataFrame:
    from clinlake.streaming import apply

    return state.select(apply.target().alias("target"), F.get_json_object("pk", "$.id").alias("id"), "op_type", F.col("image")["event"].alias("event"))


def apply_many_tables(s, d):
    """Changes of three tables with equal keys, one of them with log sequence numbers only, in two batches: each batch is one commit of all targets."""
    from clinlake.sources.store import Table
    from clinlake.streaming import apply

    table = Table(s, scratch(s, "many"))
    for batch in _thirds(src.mixed_log(s, d)):
        apply.apply_batch(table, batch)
    state = apply.current(table)
    return _targets(src.mixed_log(s, d).limit(0).selectExpr("*", "'' as pk", "after as image") if state is None else state)


def apply_levels(s, d):
    """The mixed log in six batches, by state that is put together by size, and what each target's state has in the end."""
    from clinlake.sources.store import Table
    from clinlake.streaming import apply

    table, log = Table(s, scratch(s, "levels")), src.mixed_log(s, d).cache()
    for k in range(6):
        apply.apply_batch(table, log.filter(F.pmod("n", F.lit(6)) == (k * 5) % 6), buckets=1, deltas=3, task_rows=500)
    log.unpersist()
    keys = [F.col("image")["event"].alias("event"), apply.target().alias("target")]
    return apply.current(table).select(*keys).groupBy("target", "event").agg(F.count("*").alias("keys"))


def _lines_of(log: DataFrame) -> DataFrame:
    from clinlake.operators.changes import ENVELOPE

    held = log.withColumns({f.name: F.lit(None).cast(f.dataType) for f in ENVELOPE if f.name not in log.columns}).withColumn("event_id", F.uuid())
    return held.select(F.to_json(F.struct(*ENVELOPE.fieldNames())).alias("value"))


def stream_state(s, d):
    """The mixed log as lines through a stream that is stopped and started again in mid-stream, its repeated changes known by the stream's own state."""
    from clinlake.sources.store import Table
    from clinlake.streaming import apply

    base = scratch(s, "stream")
    table = Table(s, f"{base}/table")
    for batch in _thirds(src.mixed_log(s, d)):
        _lines_of(batch).write.mode("append").text(f"{base}/in")
        apply.stream_deduplicated(s.readStream.text(f"{base}/in"), table, f"{base}/checkpoint").awaitTermination()
    return _targets(apply.current(table))


def stream_clicks_once(s, d):
    """Clicks in three deliveries by arrival, of which each repeats days of the one before, through one stream that is started for each."""
    from clinlake.streaming import dedup

    base = scratch(s, "clicks")
    clicks = src.table(s, d, "clicks")
    for since, until in (("2000-01-01", "2024-02-10"), ("2024-02-05", "2024-03-20"), ("2024-03-15", "2100-01-01")):
        at = F.col("arrived_at")
        clicks.filter((at >= F.lit(since).cast("timestamp_ntz")) & (at < F.lit(until).cast("timestamp_ntz"))).write.mode("append").parquet(f"{base}/in")
        rows = s.readStream.schema(clicks.schema).parquet(f"{base}/in")
        whole = F.unhex(F.sha2(F.to_json(F.struct(*clicks.columns), {"ignoreNullFields": "false"}), 256))
        first = dedup.first_only(rows.withColumn("row", whole), ["row"]).drop("row")
        with dedup.few_visits(s):
            query = first.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
        query.awaitTermination()
    out = s.read.schema(clicks.schema).parquet(f"{base}/out")
    return out.select("click_id", "client_id", "kind", second("ts").alias("ts"), F.sha2("props", 256).alias("props"))


def stream_two_phase(s, d):
    """The mixed log to topics by a sink of two phases, stopped and started again; what its commits hold, by topic."""
    from clinlake.sources import two_phase

    base, kinds = scratch(s, "topics"), "topic string, key string, value string"
    s.dataSource.register(two_phase.TwoPhaseSink)
    for n, batch in enumerate(_thirds(src.mixed_log(s, d))):
        events = batch.filter(F.col("n") % 3 != 2) if n else batch  # here every change is sent once
        out = events.select(changes.topic(F.col("database"), F.col("table")).alias("topic"), changes.partition_key(F.col("primary_keys")).alias("key"), F.to_json(F.coalesce("after", "before")).alias("value"))
        out.write.mode("append").parquet(f"{base}/in")
        rows = s.readStream.schema(kinds).parquet(f"{base}/in")
        rows.writeStream.format("two_phase").option("path", f"{base}/sink").option("producer", "mixed").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return two_phase.committed(s, f"{base}/sink", kinds).groupBy("topic").agg(F.count("*").alias("messages"), F.count_distinct("key").alias("keys"))


def _indexed_visits(s, d) -> str:
    from clinlake.sources import indexed

    path = scratch(s, "visits")
    v = src.visits(s, d)
    indexed.write(v.withColumn("patient", F.col("patient_id").cast("bigint")), path, "patient", "admit_time", ["admit_time", "visit_id"])
    return path


def lookup_indexed(s, d):
    """Visits of one patient from files by month, of which the index names those to open."""
    from clinlake.sources import indexed

    got = indexed.lookup(s, _indexed_visits(s, d), "patient", 77)
    return got.select("visit_id", "patient_id", "dept", second("admit_time").alias("admit_time"))


def month_from_layout(s, d):
    """partition_pruned_month() from files by month: the other months' folders are not read."""
    from clinlake.sources import indexed

    return indexed.month(s, _indexed_visits(s, d), "199703").groupBy("dept").agg(F.count("*").alias("visits"))


def visit_rollups():
    from clinlake.operators.states import Rollup

    kinds = {"dept": "dept", "visit_type": "visit_type"}
    sums, who, stay = {"visit_count": "1L"}, {"patients": "patient_id"}, {"hours": "(unix_seconds(discharge_time) - unix_seconds(admit_time)) / 3600"}
    return [
        Rollup("daily", {"visit_date": "to_date(admit_time)", "year_month": "date_format(admit_time, 'yyyy-MM')", **kinds}, sums, who, stay),
        Rollup("monthly", {"year_month": "date_format(admit_time, 'yyyy-MM')", **kinds}, sums, who, stay),
        Rollup("overall", kinds, sums, who),
    ]


def _visit_rollups(s, d):
    """Visits in five appended blocks; the monthly roll-up lacks the last one."""
    from clinlake.operators.states import Rollups
    from clinlake.sources.store import Table

    kept = Rollups(Table(s, scratch(s, "rollups")), visit_rollups())
    for k in range(5):
        kept.append(src.visits(s, d).filter(F.col("visit_id").cast("bigint") % 5 == k), ["daily", "monthly", "overall"] if k < 4 else ["daily", "overall"])
    return kept


def _close(estimate: str, exact: str) -> Column:
    """Within five standard errors of the sketch."""
    from clinlake.operators.states import HLL

    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), 5 * 1.04 / 2 ** (HLL / 2) * F.col(exact))


def rollup_states(s, d):
    """Visits and patients by month and department from merged states; whether the estimates are within their error."""
    got = _visit_rollups(s, d).report(["year_month", "dept"], ["visit_count", "patients"])
    exact = src.visits(s, d).groupBy(F.date_format("admit_time", "yyyy-MM").alias("year_month"), "dept").agg(F.count_distinct("patient_id").alias("exact"))
    return got.join(exact, ["year_month", "dept"], "left").select("year_month", "dept", "visit_count", _close("patients", "exact").alias("patients_close"))


def report_from_states(s, d):
    """Visits by month of one department, from the smallest roll-up that has both."""
    return _visit_rollups(s, d).report(["year_month", "visit_type"], ["visit_count"], {"dept": "1-URGENT", "visit_type": None})


def latency_states(s, d):
    """Quantiles of latency by type from the states of days; whether their ranks are right within two hundredths."""
    from clinlake.operators.states import Rollup

    rows = _latency(s, d).join(src.table(s, d, "events").select("event_id", F.to_date("ts").alias("day")), "event_id")
    daily = Rollup("latency", {"day": "day", "event_type": "event_type"}, {"events": "1L"}, quantiles={"ms": "ms"})
    got = daily.shown(daily.merged(daily.states(rows), ["event_type"]))
    near = lambda c, r: ((F.count_if(F.col("ms") < F.col(c)) / F.count("*") - r < 0.02) & (r - F.count_if(F.col("ms") <= F.col(c)) / F.count("*") < 0.02)).alias(f"ok_{c[3:]}")
    return rows.join(F.broadcast(got), "event_type").groupBy("event_type", "events").agg(near("ms_50", 0.5), near("ms_95", 0.95), near("ms_99", 0.99))  # a row for each type


def upsert_merge(s, d):
    fields = ["pk", "event", "pos"]
    flat = lambda x: x.select("pk", "op_type", F.coalesce(F.col("after"), F.col("before"))["event"].alias("event"), F.col("binlog_pos").alias("pos"))
    first = flat(_state(s, d, 500)).filter("op_type != 'DELETE'").select(*fields)
    later = flat(versions.latest(_keyed(s, d).filter("binlog_pos > 500"), ["pk"], ["binlog_pos"]))
    return versions.upsert(first, later, ["pk"])


def delete_anti_join(s, d):
    return versions.delete(src.patients(s, d).select("patient_id", "name"), src.visits(s, d).filter("visit_type = 'emergency'"), ["patient_id"])


def exists_semi(s, d):
    return src.patients(s, d).join(src.visits(s, d).filter("visit_type = 'inpatient'"), "patient_id", "left_semi").select("patient_id", "name")


def union_sources(s, d):
    two = src.table(s, d, "customer").select(F.lit("his").alias("system"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    other = src.table(s, d, "supplier").select(F.lit("lis").alias("system"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    return two.unionByName(other)


def offset_latest(s, d):
    e = src.table(s, d, "events").select(F.concat(F.lit("src_"), F.col("event_type")).alias("source_id"), F.lpad((F.expr("event_id div 1000")).cast("string"), 6, "0").alias("file"), F.col("event_id").alias("pos"))
    return versions.latest(e, ["source_id"], ["file", "pos"])


def event_counts_by_op(s, d):
    return src.change_log(s, d).groupBy("table", "op_type").agg(F.count("*").alias("n"))


def _latency(s, d):
    return src.table(s, d, "events").select("event_id", "event_type", ((F.col("event_id") * 7919) % 4000).alias("ms"))


def e2e_latency(s, d):
    c = src.change_log(s, d)
    return c.select("binlog_pos", (F.unix_millis(at(NOW)) - F.unix_millis("source_timestamp")).alias("latency_ms"))


def latency_histogram(s, d):
    """Events at or below each bound, in one pass."""
    bounds = (5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000)
    one = _latency(s, d).agg(*[F.count_if(F.col("ms") <= b).alias(f"b{b}") for b in bounds])
    each = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{b}").alias("count")) for b in bounds])
    return one.select(F.inline(each))


def latency_percentiles(s, d):
    p = _latency(s, d).groupBy("event_type").agg(F.percentile("ms", F.lit([0.5, 0.95, 0.99])).alias("p"))
    return p.select("event_type", *[F.round(F.col("p")[i], 3).alias(n) for i, n in enumerate(("p50", "p95", "p99"))])


def _given(df: DataFrame, **filters) -> DataFrame:
    """Optional filters: those that are None do not apply."""
    for name, value in filters.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def report_dept_daily(s, d):
    return _given(dept_daily_visits(s, d), dept="1-URGENT", visit_date=None)


def report_drug_consumption(s, d):
    r = drug_daily_orders(s, d).filter((F.col("order_date") >= "1996-01-01") & (F.col("order_date") <= "1996-12-31"))
    return r.groupBy("drug_name").agg(*[F.sum(c).alias(c) for c in ("total_orders", "executed_orders", "cancelled_orders")])


def report_patient_monthly(s, d):
    return _given(patient_monthly(s, d), year_month="1998-05", dept=None)


def report_visit_wide(s, d, most: int = 100):
    w = _given(visit_wide(s, d), dept="2-HIGH", visit_type="inpatient")
    return w.orderBy("admit_time", "visit_id").limit(min(most, 1000)).select("visit_id", "patient_name", "admit_time", "los_hours")


def topk_dept(s, d):
    return src.visits(s, d).groupBy("dept").agg(F.count("*").alias("visits")).orderBy(F.desc("visits"), "dept").limit(3)


def topk_drug(s, d):
    return _orders(s, d, ["drug_name"]).groupBy("drug_name").agg(F.count("*").alias("orders")).orderBy(F.desc("orders"), "drug_name").limit(10)


def uniq_exact(s, d):
    return src.visits(s, d).groupBy("dept").agg(F.count_distinct("patient_id").alias("patients"))


def uniq_approx(s, d):
    return rollups.sketched(src.visits(s, d))


def empi_resolve(s, d):
    lab = src.lab_results(s, d).withColumn("patient_id", F.concat(F.lit("L"), F.col("patient_id")))
    return identity.by_identifier(lab, src.master_index(s, d), "lis", "patient_id").select("result_id", "patient_id", "empi_id")


def empi_by_id(s, d):
    return identity.by_master_id(src.master_index(s, d), "EMPI-00000042").select("empi_id", "name", F.size("identifiers").alias("identifiers"))


def empi_fuzzy_match(s, d):
    p = src.patients(s, d).filter(F.col("patient_id").cast("bigint") % 20 == 0)
    q = p.select(F.col("patient_id").alias("query_id"), F.col("name").alias("q_name"), F.col("gender").alias("q_gender"), F.when(F.col("patient_id").cast("bigint") % 40 == 0, F.lit("1900-01-01")).otherwise(F.col("birth_date")).alias("q_birth"))
    return identity.fuzzy(q, src.master_index(s, d))


def _requests(s, d):
    v = src.visits(s, d)
    n = F.col("visit_id").cast("bigint")
    pick = lambda items, m: F.lit(items)[(n % m).cast("int")]
    return v.select("visit_id", pick(["role_admin", "role_doctor", "role_nurse", "role_lab_tech", "role_guest"], 5).alias("role"), pick(["Patient", "Encounter", "DiagnosticReport"], 3).alias("resource"), F.lit("2-HIGH").alias("own_dept"), F.when(n % 7 != 0, F.col("dept")).alias("dept"))


def access_check(s, d):
    return identity.check(_requests(s, d), identity.policies(s)).select("visit_id", "role", "resource", "allowed")


def access_field_filter(s, d):
    nurse = next(p for p in identity.POLICIES if p[0] == "role_nurse")
    seen = identity.visible(fhir.to_resource(_fhir_visits(s, d), "Encounter"), nurse[3])
    return seen.select("id", "resourceType", F.col("class.code").alias("class_code"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in seen.columns if c in ("id", "resourceType", "class")])).alias("json"))


def _fhir_patients(s, d):
    p = src.patients(s, d)
    return identity.by_identifier(p, src.master_index(s, d), "his", "patient_id").withColumn("_empi_id", F.when(F.col("patient_id").cast("bigint") % 4 != 0, F.col("empi_id")))


def _fhir_visits(s, d):
    return src.visits(s, d).withColumn("doctor", F.lit(None).cast("string"))


def fhir_patient(s, d):
    r = fhir.to_resource(_fhir_patients(s, d), "Patient")
    return r.select("id", "gender", "birthDate", F.col("name")[0]["text"].alias("name"), fhir.to_json(r).alias("json"))


def fhir_encounter(s, d):
    r = fhir.to_resource(_fhir_visits(s, d), "Encounter")
    return r.select("id", "status", F.col("class.code").alias("class_code"), F.col("subject.reference").alias("subject"), F.col("period.start").alias("start"), F.col("period.end").alias("end"))


def _fhir_orders(s, d):
    return _orders(s, d, ["visit_id", "drug_name", "order_time", "status"]).join(src.visits(s, d).select("visit_id", "patient_id"), "visit_id", "left")


def fhir_medication_request(s, d):
    r = fhir.to_resource(_fhir_orders(s, d), "MedicationRequest")
    return r.select("id", "status", F.col("medicationCodeableConcept.text").alias("drug"), F.col("subject.reference").alias("subject"), F.col("encounter.reference").alias("encounter"), "authoredOn")


def fhir_diagnostic_report(s, d):
    r = fhir.to_resource(src.lab_results(s, d), "DiagnosticReport")
    return r.select("id", "status", F.col("code.coding")[0]["code"].alias("code"), F.col("subject.reference").alias("subject"), "conclusion", F.col("category")[0]["coding"][0]["code"].alias("category"))


def _bundles(s, d):
    """Entries of every patient: the patient, visits, medication orders and laboratory results."""
    entry = lambda df, kind, who: df.select(F.col(who).alias("patient_id"), F.lit(kind).alias("kind"))
    parts = [entry(src.patients(s, d), "Patient", "patient_id"), entry(src.visits(s, d), "Encounter", "patient_id"), entry(_fhir_orders(s, d), "MedicationRequest", "patient_id"), entry(src.lab_results(s, d), "DiagnosticReport", "patient_id")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(src.patients(s, d).select("patient_id"), "patient_id", "left_semi")


#: Kinds of a bundle's resources by rank, with the field of their id.
KINDS = (("Patient", "patient_id"), ("Encounter", "visit_id"), ("MedicationRequest", "order_id"), ("DiagnosticReport", "result_id"))


def _staged_orders(s, d):
    """_fhir_orders() of visits that the tables hold, and its scratch folder. The last versions are chosen before drugs have names, so that what
    is widest is shuffled once and what is shuffled for the names is narrow; each step's shuffles are gone before the next."""
    keys, shown = ["l_orderkey", "l_linenumber"], ["drug_name", "order_time", "status"]
    last, chosen = staged(s, versions.latest(src.medication_versions(s, d, drugs=False), keys, ORDER_TIES, columns=["l_partkey", "order_time", "status"]), "orders")
    drugs, named = staged(s, src.table(s, d, "part").groupBy(F.col("p_partkey").alias("l_partkey")).agg(F.max("p_name").alias("drug_name")), "drugs")
    visits = src.table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("patient_id"))
    placed = last.join(visits, "l_orderkey").join(drugs.withColumn("known", F.lit(True)), "l_partkey", "left").select("patient_id", *keys, *shown, "known")
    held, path = staged(s, placed, "orders")
    _delete(s, chosen)
    _delete(s, named)
    lost = held.filter("known is null")
    held = held.filter("known").drop("known")
    if not lost.isEmpty():
        # Versions with unknown drugs do not count; where the last is one, the choice is made again among the others.
        whose = lost.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).distinct()
        others = src.medication_versions(s, d).join(whose, (F.col("l_orderkey") == F.col("k")) & F.col("l_linenumber").eqNullSafe(F.col("n")), "left_semi")
        held = held.unionByName(versions.latest(others, keys, ORDER_TIES, columns=shown).join(visits, "l_orderkey"))
    return held.select("patient_id", src.order_id().alias("order_id"), F.col("l_orderkey").cast("string").alias("visit_id"), *shown), path


def _unmapped_entries(s, d):
    """What the resources of all kinds are made from, a row each: patient_id, rank of the kind, id, and in the kind's own column the other
    fields that its rules read. Much narrower than the resources, so this is what is shuffled, sorted and stored. Entries of patients that
    the tables lack are among them, and _positioned() leaves them out. Also the names of the fields of each kind, of those that are
    timestamps, and the scratch folder that the rows are read from."""
    out, fields, timed = None, {}, {}
    orders, path = _staged_orders(s, d)
    for rank, ((kind, key), df) in enumerate(zip(KINDS, (_fhir_patients(s, d), _fhir_visits(s, d), orders, src.lab_results(s, d)))):
        fields[kind], timed[kind] = fhir.used(df, kind), fhir.timestamps(df)
        own = F.struct(*[c for c in fields[kind] if c not in ("patient_id", key)]).alias(kind)
        rows = df.select(F.col("patient_id").cast("string").alias("patient_id"), F.lit(rank).alias("rank"), F.col(key).cast("string").alias("id"), own)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.filter(F.col("patient_id").isNotNull()), fields, timed, path


def _mapped(entry, fields: dict, timed: dict) -> Column:
    """The resource of an entry as JSON. entry: a column of it, by its name."""
    out = None
    for rank, (kind, key) in enumerate(KINDS):
        get = lambda c, kind=kind, key=key: entry("patient_id") if c == "patient_id" else entry("id") if c == key else entry(kind)[c]
        made = F.to_json(F.struct(*fhir.compiled(kind, fields[kind], get=get, timed=timed[kind])))
        out = F.when(entry("rank") == rank, made) if out is None else out.when(entry("rank") == rank, made)
    return out


def _positioned(entries: DataFrame) -> DataFrame:
    """Entries of known patients with their position in the patient's bundle, and its total, from one pass. A patient is known by an entry
    of rank 0, so no join with the patients shuffles the entries once more."""
    own = Window.partitionBy("patient_id")
    made = entries.withColumns({"position": F.row_number().over(own.orderBy("rank", "id")), "total": F.count("*").over(own), "__first": F.min("rank").over(own)})
    return made.filter(F.col("__first") == 0).drop("__first")


def _search_mode(rank: Column) -> Column:
    return F.when(rank == 0, "match").otherwise("include")


def _shown(positioned: DataFrame, fields: dict, timed: dict) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in KINDS]), F.col("rank") + 1)
    return positioned.select("patient_id", "position", kind.alias("kind"), "id", _search_mode(F.col("rank")).alias("search_mode"), _mapped(F.col, fields, timed).alias("resource"), "total")


def everything_entries(s, d):
    """Bundle entries of every patient, a row each: the patient as match, then the other resources as include."""
    held, fields, timed, _ = _unmapped_entries(s, d)
    return _shown(_positioned(held), fields, timed)


def everything_colocated(s, d):
    """everything_entries() from one table of what resources are made from, in buckets of patients: no shuffle when it is read."""
    from clinlake.sources import colocated

    name = f"entries_{uuid.uuid4().hex}"
    held, fields, timed, path = _unmapped_entries(s, d)
    with shuffles_dropped(s):
        rows = sum(src.table(s, d, t).count() for t in ("customer", "orders", "lineitem", "events"))  # from the files' footers
        colocated.save(held, name, "patient_id", ["rank", "id"], colocated.buckets_for(rows))
    _tables.append((s, name))
    _delete(s, path)
    return _shown(_positioned(s.table(name)), fields, timed)


def bundle_pages(s, d, size: int = 1_000, timestamp: str = "2024-02-01T00:00:00.000Z"):
    """Bundle objects of every patient as JSON: resourceType, type, total, timestamp, entry. A bundle has `size` entries at most; patients with more have several pages."""
    page = F.floor((F.col("position") - 1) / size).cast("int")
    rows, fields, timed, _ = _unmapped_entries(s, d)
    # A page is collected from what its resources are made from, and mapped then, so that no resource is sorted.
    held = _positioned(rows).select("patient_id", (page + 1).alias("page"), "total", F.struct("position", "rank", "id", *[k for k, _ in KINDS]).alias("e"))
    one = held.groupBy("patient_id", "page").agg(F.first("total").alias("total"), F.array_sort(F.collect_list("e")).alias("es"))
    # Resources are JSON already, so a bundle is put together as text.
    resource = lambda e: _mapped(lambda c: F.col("patient_id") if c == "patient_id" else e[c], fields, timed)
    entry = lambda e: F.concat(F.lit('{"resource":'), resource(e), F.lit(',"search":{"mode":"'), _search_mode(e["rank"]), F.lit('"}}'))
    head = F.concat(F.lit('{"resourceType":"Bundle","type":"searchset","total":'), F.col("total").cast("string"), F.lit(f',"timestamp":"{timestamp}","entry":['))
    return one.select("patient_id", "page", "total", F.concat(head, F.array_join(F.transform("es", entry), ","), F.lit("]}")).alias("bundle"))


def patient_everything(s, d):
    return _bundles(s, d).groupBy("patient_id", "kind").agg(F.count("*").alias("entries"))


def fhir_bundle(s, d):
    """Bundles of a patient with his or her encounters; entries are sorted, so that reruns agree."""
    p = fhir.to_resource(_fhir_patients(s, d), "Patient")
    e = fhir.to_resource(_fhir_visits(s, d), "Encounter").select(F.col("subject.reference").alias("ref"), "id")
    held = e.groupBy("ref").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return p.select("id", F.concat(F.lit("Patient/"), "id").alias("ref")).join(held, "ref", "left").select(
        "id", F.lit("searchset").alias("type"), (1 + F.coalesce(F.size("ids"), F.lit(0))).cast("bigint").alias("total"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("encounters")
    )


def duplicate_pks(s, d):
    return versions.duplicate_keys(src.medication_versions(s, d, drugs=False), ["order_id"])


def reconcile_counts(s, d):
    left, right = src.visits(s, d), src.visits(s, d).filter(F.col("visit_id").cast("bigint") % 50 != 0)
    n = lambda df, name: df.groupBy("dept").agg(F.count("*").alias(name))
    return n(left, "source_rows").join(n(right, "target_rows"), "dept", "full").select("dept", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"), (F.coalesce("source_rows", F.lit(0)) == F.coalesce("target_rows", F.lit(0))).alias("equal"))


def reconcile_rows(s, d):
    left = src.visits(s, d).select("visit_id", "dept", "visit_type")
    right = left.withColumn("dept", F.when(F.col("visit_id").cast("bigint") % 97 == 0, F.lit("LOST")).otherwise(F.col("dept")))
    return left.exceptAll(right)


def route_default(s, d):
    """Topics of changes without a route of their own: by database and table."""
    return src.mixed_log(s, d).groupBy(changes.topic(F.col("database"), F.col("table")).alias("topic")).agg(F.count("*").alias("n"))


def dedup_positions(s, d):
    """The mixed log twice over, once for each change: by log places, or by sequence numbers where there are no places."""
    from clinlake.streaming import apply

    keyed = apply.keyed(src.mixed_log(s, d))
    half = keyed.filter(F.col("n") % 2 == 0).select("idempotency_key")
    new = versions.unseen(keyed.unionByName(keyed), half)
    return new.groupBy(apply.target().alias("target"), "op_type").agg(F.count("*").alias("changes"))


def uniq_approx_close(s, d):
    """Whether the estimates of uniq_approx() are within five standard errors."""
    both = rollups.sketched(src.visits(s, d)).withColumnRenamed("patients", "estimate").join(uniq_exact(s, d), "dept")
    return both.select("dept", "patients", _close("estimate", "patients").alias("close"))


#: Settings as a file would hold them: fields to mask, and a route.
SETTINGS = {
    "sources": [{"id": "crm_sqlserver_01", "mask_fields": {"Clients": ["city"]}}, {"id": "shop_mysql_02", "mask_fields": {"Clients": ["name"]}}],
    "topics": [{"source_id": "crm_sqlserver_01", "table": "Clients", "topic": "cdc.all.clients", "partition_key_field": "id"}, {"source_id": "shop_mysql_02", "table": "Clients", "topic": "cdc.all.clients"}],
}


def stream_settings(s, d):
    """The mixed log to topics as settings say; what each topic holds, and how many of its values show a masked field."""
    from clinlake.sources import two_phase
    from clinlake.streaming import apply

    base = scratch(s, "settings")
    _lines_of(src.mixed_log(s, d)).write.text(f"{base}/in")
    apply.stream_messages(s.readStream.text(f"{base}/in"), f"{base}/sink", f"{base}/checkpoint", SETTINGS).awaitTermination()
    got = two_phase.committed(s, f"{base}/sink", "topic string, key string, value string")
    hidden = F.coalesce(*[F.get_json_object("value", f"$.{image}.{field}") for image in ("after", "before") for field in ("city", "name")])
    return got.groupBy("topic").agg(F.count("*").alias("messages"), F.count_distinct("key").alias("keys"), F.count_if(hidden.isNotNull() & (hidden != changes.MASK)).alias("shown"))


def reconcile_tree(s, d):
    """reconcile_rows() by hash trees: only rows of leaves that differ are compared."""
    from clinlake.operators import reconcile

    left = src.visits(s, d).select("visit_id", "dept", "visit_type")
    right = left.withColumn("dept", F.when(F.col("visit_id").cast("bigint") % 97 == 0, F.lit("LOST")).otherwise(F.col("dept")))
    return reconcile.only_left(left, right, ["visit_id"])


def access_projected(s, d):
    """Visits as resources with the fields that the role of each request may see."""
    roles = F.lit(["role_admin", "role_doctor", "role_nurse", "role_lab_tech", "role_guest"])
    r = fhir.to_resource(_fhir_visits(s, d), "Encounter").withColumn("role", roles[(F.col("id").cast("bigint") % 5).cast("int")])
    return identity.projected(r, "role", identity.policies(s)).select("id", "role", "json")


def columns_grown(s, d):
    """Clicks' properties as typed columns: those of January first, then columns that appear later, which are null in the old rows."""
    c = src.table(s, d, "clicks").select("click_id", "ts", "props").distinct().withColumn("image", F.try_parse_json("props"))
    first = c.filter(F.col("ts") < F.lit("2024-02-01").cast("timestamp_ntz"))
    plain = first.withColumn("image", F.try_parse_json(F.regexp_replace("props", r'(, )?"device": \{[^}]*\}', "")))
    late = c.filter(~F.coalesce(F.col("ts") < F.lit("2024-02-01").cast("timestamp_ntz"), F.lit(False)))
    schema = changes.merged_schema(changes.grown_schema(plain), changes.grown_schema(late))
    names = schema.fieldNames()
    have = lambda *path: all(p in names for p in path[:1])
    out = changes.as_typed(plain.unionByName(late).drop("props"), schema)
    k = F.col("k") if have("k") else F.lit(None)
    os = F.col("device.os") if have("device") else F.lit(None)
    sizes = F.when(F.col("items").isNotNull(), F.size("items")) if have("items") else F.lit(None)
    return out.select("click_id", k.try_cast("bigint").alias("k"), os.cast("string").alias("os"), sizes.cast("bigint").alias("n_items"))


def visit_wide_colocated(s, d):
    """visit_wide() over tables in buckets of patients: a join without a shuffle."""
    from clinlake.sources import colocated

    n = uuid.uuid4().hex
    names = (f"visits_{n}", f"patients_{n}")
    buckets = colocated.buckets_for(src.table(s, d, "orders").count())
    colocated.save(src.visits(s, d), names[0], "patient_id", buckets=buckets)
    colocated.save(_patients(s, d), names[1], "patient_id", buckets=buckets)
    _tables.extend((s, x) for x in names)
    w = rollups.visit_wide(s.table(names[0]), s.table(names[1]).hint("merge"), at(AS_OF))
    return w.select("visit_id", "patient_id", "patient_name", "gender", "dept", "visit_type", "diagnosis", second("admit_time").alias("admit_time"), F.round("age", 4).alias("age"), "los_hours")


def name_prefix_filter(s, d):
    return src.table(s, d, "customer").filter(F.col("c_name").startswith("Customer#00000001")).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def everything_bundle(s, d):
    """everything_entries(): the entries of every patient's bundle, with position and total; resources are JSON."""
    return everything_entries(s, d)


def cdc_row_events(s, d):
    e = changes.from_row_events(src.row_events(s, d))
    return e.select("event_id", "row_seq", "op_type", F.col("primary_keys")["user_id"].alias("pk"), F.col("before")["event"].alias("before_event"), F.col("after")["event"].alias("after_event"))


def cdc_lsn_bounds(s, d):
    return changes.lsn_bounds(_coded(s, d))


def cdc_key_columns(s, d):
    constraints = s.createDataFrame([("dbo", "lab_results", "pk_lab", "PRIMARY KEY"), ("dbo", "lab_results", "uq_lab", "UNIQUE"), ("his", "visits", "pk_visits", "PRIMARY KEY")], "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = s.createDataFrame([("pk_lab", "result_id"), ("uq_lab", "item_code"), ("pk_visits", "visit_id"), ("pk_visits", "patient_id")], "constraint_name string, column_name string")
    return changes.key_columns(constraints, usage).select("table_schema", "table_name", F.array_join("key_columns", ",").alias("key_columns"))


def normalize_time(s, d):
    e = src.table(s, d, "events")
    stored = F.date_trunc("second", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    shown = stored + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 4 * 250).cast("decimal(18,6)") / 1000)
    return e.select("event_id", changes.as_text(shown, "timestamp_ntz").alias("at"))


def ods_auto_create(s, d):
    """A target table whose columns are those that the images hold."""
    state = _state(s, d).select(F.coalesce("after", "before").alias("image"), "op_type")
    columns = changes.image_columns(state, "image")
    return changes.as_table(state.filter("op_type <> 'DELETE'"), columns)


def olap_typed(s, d):
    """The text store as the typed laboratory table."""
    from clinlake.sources import olap

    t = olap.typed(_text_store(s, d), "fact_lab_results")
    return t.select("result_id", F.round("value", 2).alias("value"), F.col("is_abnormal").cast("string").alias("is_abnormal"), second("result_time").alias("result_time"))


def route_configured(s, d):
    routes = s.createDataFrame([("his_mysql_01", "Users", "cdc.his.users", "user_id")], "source_id string, table string, topic string, partition_key_field string")
    both = src.change_log(s, d).withColumn("table", F.when(F.col("binlog_pos") % 2 == 0, F.lit("Users")).otherwise(F.lit("Other")))
    return changes.routed(both, routes).groupBy("topic", "key").agg(F.count("*").alias("n"))


def distinct_topics(s, d):
    e = src.change_log(s, d)
    return e.select(changes.topic(F.col("source_id"), F.lower(F.col("after")["event"])).alias("topic")).filter("topic not like '%null'").distinct()


def empi_ranked(s, d):
    p = src.patients(s, d).filter(F.col("patient_id").cast("bigint") % 20 == 0)
    q = p.select(F.col("patient_id").alias("query_id"), F.col("name").alias("q_name"), F.col("gender").alias("q_gender"), F.col("birth_date").alias("q_birth"))
    return identity.ranked(q, src.master_index(s, d))


def list_users(s, d):
    return identity.listed(identity.users(s))


def fhir_numbers(s, d):
    """Numbers and times of a rule set with transforms, as JSON."""
    rules = {"Observation": [("id", "direct", "result_id", "toString"), ("valueQuantity.value", "direct", "raw", "toNumber"), ("effectiveDateTime", "direct", "when", "toISOString")]}
    e = src.table(s, d, "events")
    n = F.col("event_id")
    rows = e.select(n.cast("string").alias("result_id"), F.when(n % 4 == 0, "junk").when(n % 4 == 1, (n % 50).cast("string")).otherwise(F.concat((n % 50).cast("string"), F.lit(".5"))).alias("raw"), F.when(n % 3 == 0, F.lit("2024-01-02T03:04:05+08:00")).when(n % 3 == 1, F.lit("2024-01-02 03:04:05")).otherwise("no time").alias("when"))
    r = fhir.to_resource(rows, "Observation", rules)
    return r.select("id", fhir.to_json(r).alias("json"))


def seed_patients(s, d):
    return generator.rows(s, "patients", 2000).withColumn("birth_date", day("birth_date"))


def seed_visits(s, d):
    return generator.rows(s, "visits", 2000).withColumn("admit_time", second("admit_time"))


def seed_orders(s, d):
    return generator.rows(s, "orders", 2000).withColumn("order_time", second("order_time"))


def seed_labs(s, d):
    return generator.rows(s, "lab_results", 2000).withColumn("result_time", second("result_time"))


NAMES = (
    "visit_wide dept_daily_visits drug_daily_orders patient_monthly rollup_merge_partials rollup_incremental partition_pruned_month latest_version latest_version_visits "
    "latest_version_orders lookup_patient lookup_visit incremental_pull ods_typed_cast cdc_envelope cdc_decode_op cdc_pair_updates cdc_poll_range parse_skip_bad_json json_roundtrip "
    "mask_fields normalize_text route_topic route_target_table partition_key idempotency_key dedup_idempotent dedup_retention apply_changes upsert_merge delete_anti_join "
    "exists_semi union_sources offset_latest event_counts_by_op e2e_latency latency_histogram latency_percentiles report_dept_daily report_drug_consumption report_patient_monthly "
    "report_visit_wide topk_dept topk_drug uniq_exact uniq_approx empi_resolve empi_by_id empi_fuzzy_match access_check access_field_filter fhir_patient fhir_encounter "
    "fhir_medication_request fhir_diagnostic_report fhir_bundle patient_everything duplicate_pks reconcile_counts reconcile_rows name_prefix_filter "
    "everything_bundle cdc_row_events cdc_lsn_bounds cdc_key_columns normalize_time ods_auto_create olap_typed route_configured distinct_topics empi_ranked list_users fhir_numbers "
    "seed_patients seed_visits seed_orders seed_labs "
    "apply_many_tables apply_levels stream_state stream_clicks_once bundle_pages stream_two_phase lookup_indexed month_from_layout rollup_states report_from_states latency_states "
    "reconcile_tree access_projected columns_grown visit_wide_colocated everything_colocated route_default dedup_positions uniq_approx_close stream_settings"
).split()
QUERIES = {name: globals()[name] for name in NAMES}
