"""Synthetic source rows and changes, the same ones for the same numbers, made by the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What generated rows hold.
DEPARTMENTS = ["内科", "外科", "儿科", "妇产科", "急诊科", "骨科"]
VISIT_TYPES = ["outpatient", "inpatient", "emergency"]
ROUTES = ["口服", "静脉注射", "肌肉注射", "外用"]
DRUGS = ["阿莫西林", "布洛芬", "头孢克洛", "阿司匹林", "奥美拉唑", "甲硝唑"]
START = "2024-01-01 00:00:00"


def _pick(items: list[str], seq: Column) -> Column:
    return F.get(F.lit(items), (seq % len(items)).cast("int"))


def _time(seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(F.lit(START).cast("timestamp")) + seconds)


def rows(spark: SparkSession, table: str, n: int, first: int = 0) -> DataFrame:
    """n rows of patients, visits, orders or lab_results, from the number `first`. What would be random is a hash of the number."""
    seq = F.col("id")
    spread = lambda salt, m: (seq * 7919 + salt) % m
    made = spark.range(first, first + n)
    if table == "patients":
        born = F.date_add(F.lit("1950-01-01").cast("date"), spread(0, 21915).cast("int"))
        return made.select(seq.alias("patient_id"), F.concat(F.lit("患者"), seq.cast("string")).alias("name"), _pick(["M", "F"], seq).alias("gender"), born.alias("birth_date"), F.format_string("北京市朝阳区%d号", seq % 1000).alias("address"))
    if table == "visits":
        return made.select(
            seq.alias("visit_id"), (seq % 500).alias("patient_id"), _pick(DEPARTMENTS, seq).alias("dept"), F.concat(F.lit("医生"), (seq % 50).cast("string")).alias("doctor"),
            _pick(VISIT_TYPES, seq).alias("visit_type"), _time(-spread(1, 720) * 3600).alias("admit_time"), F.concat(F.lit("诊断结果"), (seq % 100).cast("string")).alias("diagnosis"),
        )
    if table == "orders":
        return made.select(
            seq.alias("order_id"), (seq % 1000).alias("visit_id"), _pick(DRUGS, seq).alias("drug_name"), F.format_string("%d.0mg", 50 + spread(2, 450)).alias("dosage"), F.lit("每日三次").alias("frequency"),
            _pick(ROUTES, seq).alias("route"), _time(seq).alias("order_time"), F.concat(F.lit("医生"), (seq % 50).cast("string")).alias("doctor"), F.lit("pending").alias("status"),
        )
    if table == "lab_results":
        return made.select(
            seq.alias("result_id"), (seq % 1000 + 1).alias("visit_id"), (seq % 500 + 1).alias("patient_id"), F.format_string("CBC%03d", seq % 20).alias("item_code"), F.lit("全血细胞计数").alias("item_name"),
            ((50 + spread(3, 150)) / 10).alias("value"), F.lit("g/L").alias("unit"), (seq % 5 == 0).alias("is_abnormal"), _time(seq).alias("result_time"),
        )
    raise ValueError(f"no such table: {table}")


def kinds(mix: str) -> list[str]:
    """The operations of a mix such as insert:8,update:1,delete:1, each as often as its weight; inserts only if it names none."""
    parts = [p.split(":", 1) for p in mix.split(",") if ":" in p]
    return [kind.strip() for kind, weight in parts for _ in range(int(weight) if weight.strip().isdigit() else 0)] or ["insert"]


def changes(spark: SparkSession, n: int, mix: str = "insert") -> DataFrame:
    """n row events on patients (op_type, keys, rows) in turns of the mix: updates and deletes are of the row of the last insert before."""
    ops = kinds(mix)
    seq = F.col("id")
    inserts = [i for i, k in enumerate(ops) if k == "insert"]
    last = [max((j for j in inserts if j <= i), default=(inserts[-1] - len(ops)) if inserts else i) for i in range(len(ops))]
    target = seq - seq % len(ops) + F.get(F.lit(last), (seq % len(ops)).cast("int"))
    made = rows(spark, "patients", n).withColumn("id", F.col("patient_id"))
    image = lambda address: F.create_map(F.lit("patient_id"), target.cast("string"), F.lit("name"), F.concat(F.lit("患者"), target.cast("string")), F.lit("address"), address)
    old, new = image(F.format_string("北京市朝阳区%d号", F.pmod(target, F.lit(1000)))), image(F.format_string("上海市浦东新区%d号", target))
    op = F.upper(_pick(ops, seq))
    return made.select(seq.alias("seq"), op.alias("op_type"), F.array(F.lit("patient_id")).alias("keys"), F.when(op == "UPDATE", F.array(old, new)).otherwise(F.array(old)).alias("rows"), _time(seq).alias("source_timestamp"))
