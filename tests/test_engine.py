import random
import threading

import pytest
from pyspark.sql import functions as F

from clinlake.functions import fhir
from clinlake.operators import changes, identity, rollups, versions
from clinlake.operators.cache import LocalCache, NotFound, ResultCache, jittered
from clinlake.sources.store import Table
from clinlake.streaming import apply

SCHEMA = "source_id string, table string, op_type string, primary_keys map<string,string>, before map<string,string>, after map<string,string>, binlog_file string, binlog_pos bigint, row_seq int, source_timestamp timestamp"


def log(*rows):
    return [("s", "patients", op, {"id": pk}, None if op != "DELETE" else {"v": v}, None if op == "DELETE" else {"v": v}, "f1", pos, 0, None) for op, pk, v, pos in rows]


C1 = log(("INSERT", "1", "a", 1), ("UPDATE", "1", "b", 2), ("INSERT", "2", "c", 3), ("DELETE", "2", "c", 4))


def state(snapshot):
    found = apply.current(snapshot)
    return {} if found is None else {r.pk: r.image["v"] for r in found.collect()}


def test_replay_and_split(spark, tmp_path):
    whole = Table(spark, str(tmp_path / "whole"))
    assert apply.recovery_plan(whole)["fresh"]
    assert apply.apply_batch(whole, spark.createDataFrame(C1, SCHEMA)) == 4
    assert state(whole) == {'{"id":"1"}': "b"}
    assert apply.apply_batch(whole, spark.createDataFrame(C1, SCHEMA)) == 0
    for cut in (1, 3):
        parts = Table(spark, str(tmp_path / f"cut{cut}"))
        apply.apply_batch(parts, spark.createDataFrame(C1[:cut], SCHEMA))
        apply.apply_batch(parts, spark.createDataFrame(C1[cut:], SCHEMA))
        assert state(parts) == state(whole)


def test_delete_then_insert(spark, tmp_path):
    s = Table(spark, str(tmp_path / "s"))
    apply.apply_batch(s, spark.createDataFrame(log(("DELETE", "1", "x", 10), ("INSERT", "1", "z", 11)), SCHEMA))
    assert state(s) == {'{"id":"1"}': "z"}


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame(C1, SCHEMA).withColumn("event_id", F.lit("e")).select(F.to_json(F.struct("event_id", *[c.split()[0] for c in SCHEMA.split(", ")])).alias("value"))
    rows.unionByName(spark.createDataFrame([("not-json",)], "value string")).write.text(str(tmp_path / "in"))
    s = Table(spark, str(tmp_path / "s"))
    for _ in range(2):
        apply.stream(spark.readStream.text(str(tmp_path / "in")), s, str(tmp_path / "c")).awaitTermination()
    assert state(s) == {'{"id":"1"}': "b"}


def test_pairs_and_codes(spark):
    rows = spark.createDataFrame([("1", "0A", 3, "old"), ("1", "0A", 4, "new"), ("2", "0A", 1, "gone")], "pk string, lsn string, op_code int, image string")
    got = {(r.pk, r.op_type): (r.before, r.after) for r in changes.pair_updates(rows, ["pk"]).collect()}
    assert got == {("1", "UPDATE"): ("old", "new"), ("2", "DELETE"): ("gone", None)}


def test_mask_and_key(spark):
    row = spark.createDataFrame([({"phone": None, "name": "n"}, {"b": "2", "a": "1"})], "image map<string,string>, keys map<string,string>")
    got = row.select(changes.masked(F.col("image"), ["phone"]).alias("m"), changes.partition_key(F.col("keys")).alias("k"), changes.canonical(F.col("keys")).alias("c")).first()
    assert (got.m, got.k, got.c) == ({"phone": "***", "name": "n"}, "1", '{"a":"1","b":"2"}')


def test_boundary_hours_and_orphans(spark):
    v = spark.createDataFrame([("1", "p", "d", "t", "x", "2024-01-01 00:59:00", None)], "visit_id string, patient_id string, dept string, visit_type string, diagnosis string, admit_time string, discharge_time timestamp").withColumn("admit_time", F.col("admit_time").cast("timestamp"))
    p = spark.createDataFrame([("q", "n", "M", "not-a-date")], "patient_id string, name string, gender string, birth_date string")
    got = rollups.visit_wide(v, p, F.lit("2024-01-01 01:01:00").cast("timestamp")).first()
    assert (got.los_hours, got.patient_name, got.age) == (1, None, None)


def test_latest_moves_groups(spark):
    rows = spark.createDataFrame([("1", "A", 10), ("1", "A", 11), ("1", "B", 12)], "id string, dept string, at int")
    assert [r.dept for r in versions.latest(rows, ["id"], ["at"]).collect()] == ["B"]


def test_fhir_nulls(spark):
    p = spark.createDataFrame([("1", None, "X", None), ("2", "n", "男", "2000-02-29T10:00:00")], "patient_id string, name string, gender string, birth_date string")
    a, b = (r.j for r in fhir.to_resource(p, "Patient").select(fhir.to_json(fhir.to_resource(p, "Patient")).alias("j")).orderBy("id").collect())
    assert '"gender":"unknown"' in a and "birthDate" not in a and '{"system":"urn:hospital:empi"}' in a
    assert '"gender":"male"' in b and '"birthDate":"2000-02-29"' in b and '"text":"n"' in b
    e = spark.createDataFrame([("1", None, None), ("2", "急诊", "2024-01-02 03:04:05")], "visit_id string, visit_type string, discharge_time string")
    got = [(r.status, r["class"]["code"], r.period) for r in fhir.to_resource(e, "Encounter").orderBy("id").collect()]
    assert got[0] == ("in-progress", None, None) and got[1][:2] == ("finished", "EMER") and got[1][2]["end"] == "2024-01-02T03:04:05.000Z"
    registry = fhir.Registry()
    registry.update("Patient", [("id", "direct", "patient_id", None)])
    assert registry.transform(p, "Patient").columns == ["id"]


def test_access(spark):
    asked = [("role_nurse", "Patient", "a", "a"), ("role_nurse", "Patient", "a", "b"), ("role_nurse", "Patient", "a", None), ("role_lab_tech", "Encounter", "a", "a"), ("nobody", "Patient", "a", "a")]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, role string, resource string, own_dept string, dept string")
    assert [r.allowed for r in identity.check(rows, identity.policies(spark)).orderBy("i").collect()] == [True, False, False, False, False]


def test_fuzzy_scores(spark):
    persons = spark.createDataFrame([("e1", "anna maria", "F", "1990-01-01"), ("e2", "bert", "M", "1980-01-01")], "empi_id string, name string, gender string, birth_date string")
    q = spark.createDataFrame([("a", "anna maria", "M", "x"), ("b", "maria", "F", "x"), ("c", "zoe", "F", "x"), ("d", "bert", "M", "1980-01-01")], "query_id string, q_name string, q_gender string, q_birth string")
    got = {(r.query_id, r.empi_id): r.score for r in identity.fuzzy(q, persons).collect()}
    assert got == {("a", "e1"): 4, ("b", "e1"): 4, ("d", "e2"): 10}


def test_cache():
    now = [0.0]
    first = LocalCache(ttl=10, most=2, clock=lambda: now[0])
    assert first.set("a", b"1") and first.set("b", b"2") and not first.set("c", b"3") and first.set("a", b"4")
    now[0] = 11
    assert first.get("a") is None and first.set("c", b"3") and len(first) <= 2
    calls = []
    cache = ResultCache(LocalCache(), LocalCache(ttl=300), known=lambda k: k == "k")
    with pytest.raises(NotFound):
        cache.get("other", lambda: b"")
    threads = [threading.Thread(target=lambda: cache.get("k", lambda: calls.append(1) or b"v")) for _ in range(20)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(calls) == 1 and cache.metrics()["size"] == 1 and not cache.flights
    cache.invalidate("k")
    assert cache.get("k", lambda: b"w") == b"w"
    with pytest.raises(ZeroDivisionError):
        cache.invalidate("k")
        cache.get("k", lambda: 1 // 0)
    assert cache.get("k", lambda: b"again") == b"again"  # a failed fetch holds nothing up
    assert 270 <= jittered(300, 10, random.Random(0)) <= 330 and jittered(0.1, 10) >= 1


def test_retry():
    waits, policy = [], apply.Retry(spread=0)
    runs = iter([ValueError(), ValueError(), None])

    def start():
        if (e := next(runs)) is not None:
            raise e

    assert apply.supervise(start, policy, waits.append) == 2 and waits == [1, 2]
    assert policy.wait(100) == 60


def test_everything_entries(spark):
    import json

    from clinlake.plans import queries as plans

    d = "/root/testdata/sf0.001"
    rows = plans.everything_entries(spark, d).collect()
    counts, held = {}, {}
    for r in rows:
        made = json.loads(r.resource)
        assert (made["resourceType"], made["id"]) == (r.kind, r.id) and r.search_mode == ("match" if r.kind == "Patient" else "include")
        counts[r.patient_id, r.kind] = counts.get((r.patient_id, r.kind), 0) + 1
        held.setdefault(r.patient_id, []).append((r.position, r.kind, r.total))
    assert counts == {(str(r.patient_id), r.kind): r.entries for r in plans.patient_everything(spark, d).collect()}
    for own in held.values():
        assert sorted(p for p, _, _ in own) == list(range(1, len(own) + 1)) and min(own)[1] == "Patient" and {t for *_, t in own} == {len(own)}
