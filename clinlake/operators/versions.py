"""Version resolution and keyed changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, StructType, VariantType


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    return isinstance(kind, AtomicType) and not isinstance(kind, VariantType)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], deleted: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The last version of every key. Two-phase aggregation: versions of a hot key are merged before the shuffle.

    order: later values win, the first column first; name enough columns to leave no tie. deleted: versions that end a
    key. columns: those that are wanted besides the keys; only these and the order are read and shuffled.
    """
    wanted = [c for c in (df.columns if columns is None else columns) if c not in keys]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    gone = [] if deleted is None else [deleted.alias("__gone")]
    # What is in the order is not carried twice.
    place = {o: f"o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    rest = [c for c in wanted if c not in place]
    whole = F.struct(*[F.col(f"`{c}`") for c in rest], *gone, F.lit(0).alias("__one"))
    if _sortable(df.select(*[f"`{c}`" for c in rest]).schema):
        # The largest of (order, rest) is one of the last in order.
        out = df.groupBy(*keys).agg(F.max(F.struct(rank.alias("r"), whole.alias("w"))).alias("__last"))
        of = lambda c: F.col("__last.r")[place[c]] if c in place else F.col("__last.w")[c]
    else:
        whole = F.struct(*[F.col(f"`{c}`") for c in wanted], *gone, F.lit(0).alias("__one"))
        out = df.groupBy(*keys).agg(F.struct(F.max_by(whole, rank).alias("w")).alias("__last"))
        of = lambda c: F.col("__last.w")[c]
    out = out.select(*keys, *[of(c).alias(c) for c in wanted], *([F.col("__last.w")["__gone"].alias("__gone")] if gone else []))
    if gone:
        out = out.filter(~F.coalesce("__gone", F.lit(False)))
    order_of = [*keys, *wanted] if columns is not None else df.columns
    return out.select(*[f"`{c}`" for c in order_of])


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str], op: str = "op_type") -> DataFrame:
    """The state after changes, of which there is one for each key: untouched rows, and changed rows that are not deleted."""
    untouched = state.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changes.filter(F.col(op) != "DELETE").select(*state.columns))


def delete(state: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.join(gone.select(*keys), list(keys), "left_anti")


def unseen(events: DataFrame, ledger: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """Events that the ledger does not hold, one for each key."""
    return events.join(ledger.select(key), key, "left_anti").dropDuplicates([key])


def retained(ledger: DataFrame, now: Column, hours: int = 168, at: str = "applied_at") -> DataFrame:
    return ledger.filter(F.col(at) >= F.timestamp_seconds(F.unix_seconds(now) - hours * 3600))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
