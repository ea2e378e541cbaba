"""Typed analytical tables from operational tables of text, by watermark."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators import changes
from clinlake.sources.store import Table, month_of

UPDATED = "_cdc_updated_at"


@dataclass(frozen=True)
class Spec:
    """Columns that are not text, with their types; the time that gives the month; the key; the order within a file."""

    columns: tuple[str, ...]
    key: str
    sort: tuple[str, ...]
    at: str | None = None
    types: dict[str, str] = field(default_factory=dict)


META = ("_cdc_source_id", "_cdc_op_type", UPDATED)
SPECS = {
    "dim_patients": Spec(("patient_id", "name", "gender", "birth_date", "address", "created_at"), "patient_id", ("patient_id",)),
    "fact_visits": Spec(
        ("visit_id", "patient_id", "dept", "doctor", "visit_type", "admit_time", "discharge_time", "diagnosis", "created_at"),
        "visit_id", ("dept", "admit_time", "visit_id"), "admit_time", {"admit_time": "timestamp", "discharge_time": "timestamp"},
    ),
    "fact_orders": Spec(
        ("order_id", "visit_id", "drug_name", "dosage", "frequency", "route", "order_time", "doctor", "status", "created_at"),
        "order_id", ("drug_name", "order_time", "order_id"), "order_time", {"order_time": "timestamp"},
    ),
    "fact_lab_results": Spec(
        ("result_id", "visit_id", "patient_id", "item_code", "item_name", "value", "unit", "ref_range", "is_abnormal", "result_time", "report_time", "lab_section", "created_at"),
        "result_id", ("lab_section", "result_time", "result_id"), "result_time", {"value": "double", "is_abnormal": "flag", "result_time": "timestamp", "report_time": "timestamp"},
    ),
}


def typed(rows: DataFrame, name: str) -> DataFrame:
    """Text columns as the types of a table; values that do not parse are null, columns that lack are null, others are left out."""
    spec = SPECS[name]

    def one(c: str):
        value = F.col(c) if c in rows.columns else F.lit(None).cast("string")
        kind = spec.types.get(c, "string")
        return (value.try_cast("boolean").cast("int") if kind == "flag" else value.try_cast(kind)).alias(c)

    return rows.select(*[one(c) for c in spec.columns], *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in META])


def sync(source: DataFrame, table: Table, name: str, batch: int = 500) -> int:
    """Append the next rows of an operational table to an analytical one; returns their number.

    Rows and watermark are one commit, so a crash loses and repeats nothing. The watermark is the time and the key of
    the last row; it moves only if there are rows.
    """
    spec = SPECS[name]
    mark = table.marks.get(name)
    rows = source.filter(F.col(UPDATED).isNotNull())
    if mark is None:
        rows = rows.orderBy(UPDATED, spec.key).limit(batch)
    else:
        rows = changes.incremental(rows, UPDATED, spec.key, (F.timestamp_micros(F.lit(mark[0])), mark[1]), batch)
    rows = rows.cache()
    try:
        last = rows.agg(F.count("*").alias("n"), F.max(F.struct(F.unix_micros(UPDATED).alias("t"), F.col(spec.key).alias("k"))).alias("m")).first()
        if last.n:
            month = month_of(spec.at) if spec.at else F.lit("all")
            table.commit({name: (typed(rows, name), month)}, marks={name: [last.m.t, last.m.k]}, sort=spec.sort)
        return last.n
    finally:
        rows.unpersist()
