"""Wide view and roll-ups, in full and incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hours_between(start: Column, stop: Column) -> Column:
    """Hour boundaries between two times, not elapsed hours."""
    hour = lambda t: F.unix_seconds(F.date_trunc("hour", t))
    return ((hour(stop) - hour(start)) / 3600).cast("bigint")


def visit_wide(visits: DataFrame, patients: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Visits with their patients: age at admission in years of 365 days, and length of stay in hour boundaries.

    A visit without a patient stays, with nulls. No broadcast is forced: the patients grow with the data.
    """
    p = patients.select("patient_id", F.col("name").alias("patient_name"), "gender", F.expr("try_cast(birth_date AS date)").alias("born"))
    age = F.datediff(F.to_date("admit_time"), F.col("born")) / 365
    stay = hours_between(F.col("admit_time"), F.coalesce("discharge_time", as_of if as_of is not None else F.current_timestamp()))
    return visits.join(p, "patient_id", "left").select("visit_id", "patient_id", "patient_name", "gender", "dept", "visit_type", "diagnosis", "admit_time", "discharge_time", age.alias("age"), stay.alias("los_hours"))


def dept_daily(visits: DataFrame) -> DataFrame:
    return visits.groupBy(F.to_date("admit_time").alias("visit_date"), "dept", "visit_type").agg(F.count("*").alias("visit_count"), F.count_distinct("patient_id").alias("patient_count"))


def drug_daily(orders: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return orders.groupBy(F.to_date("order_time").alias("order_date"), "drug_name").agg(F.count("*").alias("total_orders"), n("executed").alias("executed_orders"), n("cancelled").alias("cancelled_orders"))


def patient_monthly(visits: DataFrame) -> DataFrame:
    return visits.groupBy(F.date_format("admit_time", "yyyy-MM").alias("year_month"), "dept", "visit_type").agg(F.count_distinct("patient_id").alias("patient_count"), F.count("*").alias("visit_count"))


def merge_partials(parts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum the measures of partial roll-ups. Distinct counts cannot be summed: carry sketches or recompute."""
    return parts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def incremental(rollup: DataFrame, base: DataFrame, changed: DataFrame, keys: Sequence[str], build, derived: dict[str, Column] | None = None) -> DataFrame:
    """The roll-up after a change of base: groups that changed rows touch are built anew, others stay.

    base: the resolved table after the change. changed: rows of it, old and new, in the roll-up's keys. derived: keys
    that base lacks, as columns of it. Only rows of touched groups are aggregated.
    """
    touched = changed.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()
    same = [F.col(f"__{k}").eqNullSafe(F.col(f"__t_{k}")) for k in keys]
    held = base.withColumns({f"__{k}": (derived or {}).get(k, F.col(k) if k in base.columns else F.lit(None)) for k in keys})
    rows = held.join(touched, same, "left_semi").select(*[f"`{c}`" for c in base.columns])
    kept = rollup.withColumns({f"__{k}": F.col(k) for k in keys}).join(touched, same, "left_anti").select(*[f"`{c}`" for c in rollup.columns])
    return kept.unionByName(build(rows))


def sketched(visits: DataFrame) -> DataFrame:
    """Patients of each department as mergeable sketches, and their estimate."""
    return visits.groupBy("dept").agg(F.hll_sketch_agg("patient_id").alias("sketch")).select("dept", F.hll_sketch_estimate("sketch").alias("patients"))
