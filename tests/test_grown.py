"""Hash trees, projection row by row, columns that grow, and tables in buckets."""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators import changes, identity, reconcile
from clinlake.plans import queries as plans
from clinlake.sources import adapters, colocated

DATA = "/root/testdata/sf0.001"


def test_only_unequal_leaves_are_opened(spark):
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    right = left.withColumn("v", F.when(F.col("k").isin(5, 77), "x").otherwise(F.col("v"))).filter("k <> 9000").unionByName(spark.createDataFrame([(123, "4"), (50_000, None)], "k bigint, v string"))
    trees = reconcile.tree(left, ["k"]), reconcile.tree(right, ["k"])
    leaves = reconcile.unequal_leaves(*trees)
    assert leaves.count() == 5
    got = reconcile.only_left(left, right, ["k"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.exceptAll(right).collect())) == [(5, "5"), (77, "0"), (9000, "5")]
    assert sorted(map(tuple, reconcile.only_left(right, left, ["k"]).collect()), key=str) == sorted(map(tuple, right.exceptAll(left).collect()), key=str)
    assert reconcile.only_left(left, left, ["k"]).count() == 0 and reconcile.unequal_leaves(trees[0], trees[0]).count() == 0
    near = reconcile.only_left(left, right, ["k"], leaves)._jdf.queryExecution().executedPlan().toString()
    assert near.index("Exchange") < near.index("LeftSemi")  # rows of equal leaves go before the rows are shuffled
    parts = [reconcile.tree(left.filter(c), ["k"]) for c in ("k % 3 = 0", "k % 3 <> 0")]
    assert sorted(map(tuple, reconcile.added(*parts).collect())) == sorted(map(tuple, trees[0].collect()))
    empty = left.limit(0)
    assert reconcile.only_left(empty, left, ["k"]).count() == 0 and reconcile.only_left(left, empty, ["k"]).count() == 20_000


def test_each_row_is_projected_by_its_own_role(spark):
    rows = [("Patient", "1", "n", None, "nurse"), ("Patient", "2", "n", "g", "admin"), ("Patient", "3", "n", "g", "guest"), ("Patient", "4", "n", "g", None)]
    rules = spark.createDataFrame([("nurse", ["name"]), ("admin", ["*"])], "role string, fields array<string>")
    got = identity.projected(spark.createDataFrame(rows, "resourceType string, id string, name string, gender string, role string"), "role", rules)
    made = {r.id: r.json and json.loads(r.json) for r in got.collect()}
    kind = {"resourceType": "Patient"}
    assert made == {"1": {**kind, "id": "1", "name": "n"}, "2": {**kind, "id": "2", "name": "n", "gender": "g"}, "3": None, "4": None}


def images(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.try_parse_json("t").alias("image"))


def test_a_late_column_is_null_in_old_rows_and_typed_in_new_ones(spark):
    old = images(spark, '{"id": 1, "v": 2}', '{"id": 2}', None, "junk", "[1]", "5")
    new = images(spark, '{"id": 3, "v": 2.5, "at": {"x": 1}, "tags": ["a"]}', '{"id": "text", "none": null}')
    first = changes.grown_schema(old)
    assert {f.name: f.dataType.simpleString() for f in first} == {"id": "bigint", "v": "bigint"} or not first.fieldNames()
    first = changes.grown_schema(old.filter("i < 2"))
    schema = changes.merged_schema(first, changes.grown_schema(new))
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert list(kinds)[:2] == ["id", "v"] and kinds["id"] == "string" and kinds["v"] in ("double", "decimal(2,1)") and kinds["at"] == "struct<x:bigint>" and kinds["tags"] == "array<string>" and kinds["none"] == "string"
    got = {r.i: r for r in changes.as_typed(old, schema).collect()}
    assert got[0].id == "1" and got[0].v == 2 and got[0]["at"] is None and got[3].id is None and got[4].id is None
    late = {r.i: r for r in changes.as_typed(new, schema).collect()}
    assert late[0]["at"].x == 1 and late[0].tags == ["a"] and float(late[0].v) == 2.5 and late[1].id == "text"
    assert changes.grown_schema(old.limit(0)) == T.StructType([]) and changes.as_typed(old, T.StructType([])).columns == ["i"]


def test_buckets_join_without_a_shuffle(spark):
    names = [f"t{n}_{uuid.uuid4().hex}" for n in range(2)]
    try:
        colocated.save(adapters.visits(spark, DATA), names[0], "patient_id", buckets=4)
        colocated.save(adapters.patients(spark, DATA), names[1], "patient_id", buckets=4)
        visits, patients = (spark.table(n) for n in names)
        both = visits.join(patients.hint("merge"), "patient_id", "left")
        text = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        grouped = visits.groupBy("patient_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in grouped
        assert both.count() == adapters.visits(spark, DATA).count()
    finally:
        colocated.drop(spark, *names)
    wide = plans.visit_wide_colocated(spark, DATA)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, wide.collect())) == sorted(map(str, plans.visit_wide(spark, DATA).collect()))
    entries = plans.everything_colocated(spark, DATA)
    assert "Exchange" not in entries._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, entries.collect())) == sorted(map(str, plans.everything_bundle(spark, DATA).collect()))
    plans.release()
