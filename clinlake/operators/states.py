"""Roll-ups kept as mergeable states, and reports from them.

A roll-up has groups, sums, distinct counts as HyperLogLog sketches, and quantiles as KLL sketches. Every appended block of
base rows adds the states of its groups, in the commit that adds the rows; states of a group are merged when they are read, or
when runs are put together by size. Unlike sums, distinct counts and quantiles cannot be merged as numbers; sketches can.

A roll-up carries the number of the last block that it holds. A report takes the roll-up with the fewest states whose groups
and measures cover it, and makes the states of later blocks from the base, so it is never stale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.sources.store import Table, to_merge

#: Registers of the sketches as powers of two: the standard error of a distinct count is 1.04 / sqrt(2**HLL). Accuracy of quantiles: ranks within 1 % or so.
HLL, KLL = 12, 400
FANOUT = 4


@dataclass(frozen=True)
class Rollup:
    """Names of groups and measures, with SQL over the base's columns."""

    name: str
    groups: Mapping[str, str]
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, str] = field(default_factory=dict)

    @property
    def measures(self) -> set[str]:
        return {*self.sums, *self.distinct, *self.quantiles}

    def states(self, rows: DataFrame) -> DataFrame:
        """One row for each group of base rows."""
        made = [F.sum(F.expr(e)).alias(n) for n, e in self.sums.items()]
        made += [F.hll_sketch_agg(F.expr(f"cast({e} as string)"), HLL).alias(n) for n, e in self.distinct.items()]
        made += [F.kll_sketch_agg_double(F.expr(f"cast({e} as double)"), KLL).alias(n) for n, e in self.quantiles.items()]
        return rows.groupBy(*[F.expr(e).alias(n) for n, e in self.groups.items()]).agg(*made)

    def merged(self, states: DataFrame, groups: Sequence[str] | None = None, measures: Sequence[str] | None = None) -> DataFrame:
        """States of fewer groups, or of equal groups put together."""
        wanted = lambda names: [n for n in names if measures is None or n in measures]
        made = [F.sum(n).alias(n) for n in wanted(self.sums)] + [F.hll_union_agg(n).alias(n) for n in wanted(self.distinct)]
        made += [F.kll_merge_agg_double(n).alias(n) for n in wanted(self.quantiles)]
        return states.groupBy(*(self.groups if groups is None else groups)).agg(*made)

    def shown(self, states: DataFrame, ranks: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
        """Numbers in place of sketches; quantiles as name_rank, such as ms_95."""
        out: list[Column] = []
        for c in states.columns:
            if c in self.distinct:
                out.append(F.hll_sketch_estimate(c).alias(c))
            elif c in self.quantiles:
                held = F.kll_sketch_get_n_double(F.col(c)) > 0  # a group may have no values
                out += [F.when(held, F.kll_sketch_get_quantile_double(F.col(c), F.lit(r))).alias(f"{c}_{round(r * 100)}") for r in ranks]
            else:
                out.append(F.col(c))
        return states.select(*out)


class Rollups:
    """A base and its roll-ups in one table."""

    def __init__(self, table: Table, rollups: Sequence[Rollup]):
        self.table, self.rollups = table, {r.name: r for r in rollups}

    def append(self, rows: DataFrame, only: Sequence[str] | None = None) -> int:
        """Add a block of base rows, and its states to the roll-ups (`only`: to some; `catch_up` does the others). Returns the number of the block."""
        block = self.table.marks.get("base", 0) + 1
        held = rows.cache()
        try:
            # A block is one bucket, and so are the states of a roll-up: neither may go to one task.
            add, drop, marks = {"base": (held, F.lit(str(block)), None, True, {("base", str(block)): held.count()})}, set(), {"base": block}
            for name in self.rollups if only is None else only:
                if self.table.marks.get(name, 0) == block - 1:
                    add[f"rollup/{name}"], gone = self._added(name, self.rollups[name].states(held))
                    drop |= gone
                    marks[name] = block
            self.table.commit(add, marks=marks, drop=drop)
        finally:
            held.unpersist()
        return block

    def _added(self, name: str, states: DataFrame) -> tuple[tuple, set[str]]:
        runs = [(path, rows) for _, _, path, rows in self.table.runs(f"rollup/{name}")]
        count = states.count()
        gone = to_merge(runs, count, FANOUT)
        if gone:
            states = self.rollups[name].merged(self.table.read_runs(gone).unionByName(states))
        return (states, F.lit("all"), None, True, None if gone else {(f"rollup/{name}", "all"): count}), gone

    def _late(self, name: str) -> DataFrame | None:
        """Base rows of blocks that a roll-up does not hold."""
        last = self.table.marks.get(name, 0)
        blocks = {str(n) for n in range(last + 1, self.table.marks.get("base", 0) + 1)}
        return self.table.read("base", blocks) if blocks else None

    def catch_up(self, name: str) -> int:
        """Bring a roll-up up to the base; returns how many blocks it lacked."""
        behind = self.table.marks.get("base", 0) - self.table.marks.get(name, 0)
        rows = self._late(name)
        if rows is not None:
            add, drop = self._added(name, self.rollups[name].states(rows))
            self.table.commit({f"rollup/{name}": add}, marks={name: self.table.marks["base"]}, drop=drop)
        return behind

    def freshness(self, name: str) -> dict:
        base, mark = self.table.marks.get("base", 0), self.table.marks.get(name, 0)
        return {"base": base, "holds": mark, "fresh": base == mark}

    def covering(self, groups: Sequence[str], measures: Sequence[str], filters: Sequence[str] = ()) -> str:
        """The roll-up with the fewest states that has these groups, filters and measures."""
        able = [r.name for r in self.rollups.values() if {*groups, *filters} <= set(r.groups) and set(measures) <= r.measures]
        if not able:
            raise ValueError(f"no roll-up has {sorted({*groups, *filters})} with {sorted(measures)}")
        return min(able, key=lambda n: (sum(rows for *_, rows in self.table.runs(f"rollup/{n}")), n))

    def report(self, groups: Sequence[str], measures: Sequence[str], where: Mapping[str, object] | None = None, ranks: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
        """Measures by groups. where: values of groups; those that are None do not apply."""
        given = {k: v for k, v in (where or {}).items() if v is not None}
        rollup = self.rollups[self.covering(groups, measures, list(given))]
        states, late = self.table.read(f"rollup/{rollup.name}"), self._late(rollup.name)
        if late is not None:
            states = rollup.states(late) if states is None else states.unionByName(rollup.states(late))
        if states is None:
            raise ValueError("the base is empty")
        for name, value in given.items():
            states = states.filter(F.col(name) == value)
        return rollup.shown(rollup.merged(states, groups, measures), ranks)
