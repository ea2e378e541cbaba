"""What is shuffled, kept and made grows with the input, not with its squares or its widest rows."""

import json
import os
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from clinlake.functions import fhir
from clinlake.llm import near_dedup
from clinlake.operators import identity, versions
from clinlake.plans import queries as plans
from clinlake.sources import colocated, indexed

DATA = "/root/testdata/sf0.001"

PEOPLE = "empi_id string, name string, gender string, birth_date string"
ASKED = "query_id string, q_name string, q_gender string, q_birth string"


def test_equal_lengths_meet_in_no_pieces(spark):
    people = spark.createDataFrame([(f"e{i}", f"Customer#{i:09d}", "MF"[i % 2], str(i)) for i in range(200)], PEOPLE)
    asked = spark.createDataFrame([(f"q{i}", f"Customer#{i:09d}", "MF"[i % 2], None) for i in range(0, 200, 20)], ASKED)
    met = identity._inside(people, "name", "gender", asked, "q_name", "q_gender")
    assert met.count() == 0 and identity._pieces(people, "name", asked.selectExpr("collect_set(length(q_name)) as __widths")).count() == 0
    assert {(r.query_id[1:], r.empi_id[1:]) for r in identity.fuzzy(asked, people).collect()} == {(str(i), str(i)) for i in range(0, 200, 20)}


def test_long_names_inside_longer_ones(spark):
    long = "n" * 20 + "".join(chr(97 + i % 26) for i in range(60))
    people = spark.createDataFrame([("e1", long, "M", "1"), ("e2", long[5:70], "M", "2"), ("e3", long[20:53], "M", "3"), ("e4", long[20:52], "M", "4"), ("e5", "z" + long[20:53], "M", "5"), ("e6", long, "F", "6")], PEOPLE)
    asked = spark.createDataFrame([("q1", long[20:53], "M", None), ("q2", long, "M", None)], ASKED)
    names = {r.empi_id: (r.name, r.gender) for r in people.collect()}
    want = {(q, e) for q, n in (("q1", long[20:53]), ("q2", long)) for e, (p, g) in names.items() if n == p or (g == "M" and (n in p or p in n))}
    assert {(r.query_id, r.empi_id) for r in identity.fuzzy(asked, people).collect()} == want


def test_resources_are_made_after_the_shuffle(spark):
    for made in (plans.everything_bundle, plans.bundle_pages, plans.everything_colocated):
        df = made(spark, DATA)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "urn:hospital" in text and "urn:hospital" not in text[text.index("Window [") :]  # the plan's lower part comes last
    name = plans._tables[-1][1]
    assert "resource" not in spark.table(name).columns
    plans.release()


def test_entries_meet_their_patient_in_one_shuffle(spark):
    for made in (plans.everything_bundle, plans.bundle_pages):
        text = made(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" not in text and "lineitem" not in text and text.index("Window [") < text.index("Union")
    plans.release()


def test_disk_is_free_when_the_table_in_buckets_is_written(spark):
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before, made = shuffled(), len(plans._made)
    entries = plans.everything_colocated(spark, DATA)
    for _ in range(50):  # files go in the background
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and len(plans._made) > made and not [p for _, p in plans._made[made:] if os.path.exists(p)]
    assert entries.count() == plans.everything_bundle(spark, DATA).count()
    plans.release()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_entries_of_unknown_patients_visits_and_drugs(spark, tmp_path):
    line = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_shipdate timestamp_ntz, l_returnflag string"
    rows = {
        "customer": ([(1, "a", "X"), (2, "b", "X"), (None, "n", "X")], "c_custkey bigint, c_name string, c_mktsegment string"),
        "orders": ([(10, 1), (11, 9), (12, None), (14, 2)], "o_orderkey bigint, o_custkey bigint"),
        "part": ([(1, "p1"), (2, "p2"), (2, "p0"), (3, None), (None, "none")], "p_partkey bigint, p_name string"),
        "lineitem": (
            [(10, 1, 1, "2024-01-01", "A"), (10, 1, 2, "2024-01-02", "R"), (10, 1, 99, "2024-01-03", "N"), (10, 2, 3, "2024-01-01", "A"), (10, 3, 99, "2024-01-01", "A"), (10, 4, None, "2024-01-01", "A")]
            + [(11, 1, 1, "2024-01-01", "A"), (12, 1, 1, "2024-01-01", "A"), (13, 1, 1, "2024-01-01", "A"), (None, 1, 1, "2024-01-01", "A")]
            + [(14, None, 99, "2024-01-02", "A"), (14, None, 1, "2024-01-01", "N"), (14, 7, 1, None, "A"), (14, 7, 2, "2024-01-01", "N")],
            line,
        ),
        "events": ([(100, 2), (101, 9), (102, None)], "event_id bigint, user_id bigint"),
    }
    more = {
        "orders": {"o_orderpriority": "'1-URGENT'", "o_orderstatus": "'O'", "o_orderdate": "timestamp_ntz'2024-01-01'"}, "events": {"event_type": "'view'", "value": "60d", "ts": "timestamp_ntz'2024-01-01'"},
        "lineitem": {**{c: "1d" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}, "l_suppkey": "1L", "l_shipdate": "cast(l_shipdate as timestamp_ntz)"},
    }
    for name, (held, schema) in rows.items():
        df = spark.createDataFrame(held, schema.replace("timestamp_ntz", "string"))
        df.withColumns({c: F.expr(e) for c, e in more.get(name, {}).items()}).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = {("1", 1, "1"): 4, ("1", 2, "10"): 4, ("1", 3, "10-1"): 4, ("1", 4, "10-2"): 4, ("2", 1, "2"): 5, ("2", 2, "14"): 5, ("2", 3, "14"): 5, ("2", 4, "14-7"): 5, ("2", 5, "100"): 5}
    for made in (plans.everything_bundle, plans.everything_colocated):
        got = made(spark, str(tmp_path)).collect()
        assert {(r.patient_id, r.position, r.id): r.total for r in got} == want and len(got) == len(want)
        meds = {r.id: json.loads(r.resource) for r in got if r.kind == "MedicationRequest"}
        assert {k: (m.get("medicationCodeableConcept", {}).get("text"), m["status"]) for k, m in meds.items()} == {"10-1": ("p2", "cancelled"), "10-2": (None, "completed"), "14": ("p1", "active"), "14-7": ("p2", "active")}
    plans.release()


def test_buckets_grow_with_the_rows():
    assert colocated.buckets_for(0) == colocated.BUCKETS
    assert [colocated.buckets_for(n * 1_000_000_000) for n in (1, 2, 4)] == [500, 1000, 2000]


def test_latest_carries_the_order_once(spark):
    rows = spark.createDataFrame([(1, "a", 1, "x", {"k": "1"}), (1, "b", 2, None, None), (2, "c", None, "y", {"k": "2"}), (2, "d", 1, "z", {"k": "3"})], "k int, v string, at int, w string, m map<string,string>")
    got = versions.latest(rows, ["k"], ["at"], columns=["v", "at", "w"])
    assert "max_by" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, "b", 2, None), (2, "d", 1, "z")]
    whole = versions.latest(rows, ["k"], ["at"], deleted=F.col("w").isNull())
    assert [tuple(r) for r in whole.collect()] == [(2, "d", 1, "z", {"k": "3"})]  # a map has no order


def test_times_of_resources(spark):
    texts = ["1969-12-31 23:59:59.999", "2024-02-29 00:00:00", "0001-01-01 05:06:07.5", "2024-01-01 01:02:03.123456", "9999-12-31 23:59:59"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", F.expr("cast(t as timestamp)").alias("at"))
    got = rows.select(fhir._transform(F.col("at"), "toISOString", True).alias("new"), fhir._transform(F.col("at"), "toISOString").alias("old")).collect()
    assert [r.new for r in got] == [r.old for r in got] and got[0].new == "1969-12-31T23:59:59.999Z" and got[-1].new is None


def test_bitmaps_are_made_from_numbers(spark, tmp_path):
    rows = spark.range(3_000).select(F.col("id").alias("k"), F.expr("timestamp'2024-01-01' + make_dt_interval(id % 90)").alias("at"))
    path = str(tmp_path / ("long-name-" * 15))
    indexed.write(rows, path, "k", "at", files=7)
    kept = spark.read.parquet(f"{path}/data").selectExpr("_metadata.file_path as file", "k as key")
    bits = indexed._bits(kept, 32_768)
    assert [f.dataType.simpleString() for f in bits.schema] == ["bigint", "bigint"] and bits.count() == 3_000 * indexed.PROBES
    of = {r.key: r.file for r in kept.collect()}
    for k in range(0, 3_000, 97):
        assert of[k] in indexed.candidates(spark, path, k) and indexed.lookup(spark, path, "k", k).count() == 1
    assert {r.file for r in spark.read.parquet(f"{path}/filter").collect()} == set(of.values())


def test_ranks_are_made_in_place():
    near_dedup._table.clear()
    tracemalloc.start()
    got = near_dedup._ranks(200)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.random.Generator(np.random.PCG64(23)).permutation(near_dedup.POSITIONS).astype(np.uint32)
    assert (got[:, 0] == np.concatenate([want, want[:199]])[: len(got)]).all() and (got[-1] == np.concatenate([want, want[:199]])[-200:]).all()
    assert most < 1.5 * want.nbytes
