"""Repair of conversations by error-correcting Earley parsing.

The grammar of roles, `(s?(ua)+)?` by initials, is parsed over a conversation's rows with error productions: a row
may be deleted or given another role, and a turn with an empty text may be inserted. The chart holds one set of items
for each place between rows; an item keeps only its cheapest (cost, audit), where the audit names the edits by their
initials and, of equal costs, the least in ASCII stays. Every production ends in a nonterminal or in END, so what
waits for a completed item is complete with it: the item that has scanned END holds the parse, and its audit is the
repair.

Two equal costs are never of audits of which one begins with the other: what follows could only be insertions, which cost
something. So the lesser audit stays the lesser whatever comes after, and one for each item is enough.

A conversation is streamed in the order of its rows and is never held as a whole. Of the chart only the last set is
needed, without items that others can make up for; once all its items begin with the same edits, these are final, and their rows are given out and forgotten. Rows
that must be deleted are known by their fault alone, so of texts only those of the last few rows are held. The digest of
a conversation needs its texts in order, so one conversation is read by one task; it holds no more for a longer one
than the audit that it returns.

Rows go by turn (null first), then role, then text. Faults, of which the first counts: blank (no character but white
space), duplicate (role and text stand in an earlier row of the conversation), truncated (the last such character does not end a sentence).
Nulls: a null role or text is one space; a null conv_id is one conversation; a null turn is before others and
counts in no gap. A role that is empty has no initial and cannot be kept. Repeated rows are duplicates. Very long texts
are read whole. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm import common

END = "end"
#: Alternatives of every nonterminal. All end in a nonterminal or in END.
GRAMMAR: dict[str, tuple[tuple[str, ...], ...]] = {
    "Chat": ((END,), ("system", "Pair"), ("Pair",)),
    "Pair": (("user", "Reply"),),
    "Reply": (("assistant", "Pair"), ("assistant", END)),
}
#: Roles that a row may be given, and that may be inserted.
GIVEN = ("user", "assistant")
#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What any item can make up for by edits of its own: inserted turns of both roles. An item that costs more than this above the least is of no use.
SLACK = 2 * INSERT
#: Edits after which the last set is looked through for final ones.
FLUSH = 24

#: A column that is true where a row only says that there is a conversation.
MARK = "__structure_gone"

Item = tuple[str, int, int]
Value = tuple[int, str]
LEGAL = ("su", "ua", "au")


def _symbol(item: Item) -> str:
    return GRAMMAR[item[0]][item[1]][item[2]]


def _offer(chart: dict[Item, Value], item: Item, value: Value) -> bool:
    if item in chart and chart[item] <= value:
        return False
    chart[item] = value
    return True


def predicted(chart: dict[Item, Value]) -> dict[Item, Value]:
    """The set with what its items predict and insert."""
    todo = list(chart)
    while todo:
        item = todo.pop()
        (cost, audit), symbol = chart[item], _symbol(item)
        if symbol in GRAMMAR:
            todo += [new for n in range(len(GRAMMAR[symbol])) if _offer(chart, new := (symbol, n, 0), (cost, audit))]
        elif symbol in GIVEN and _offer(chart, new := (item[0], item[1], item[2] + 1), (cost + INSERT, audit + "I")):
            todo.append(new)
    return chart


def scanned(chart: dict[Item, Value], role: str, fault: str) -> dict[Item, Value]:
    """The set after a row, before prediction."""
    out: dict[Item, Value] = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for item, (cost, audit) in chart.items():
        symbol = _symbol(item)
        if symbol in GRAMMAR:
            continue
        _offer(out, item, (cost + DELETE, audit + "D"))
        if fault in ("blank", "duplicate") or symbol == END:
            continue
        after = (item[0], item[1], item[2] + 1)
        if role[:1] == symbol[0]:
            _offer(out, after, (cost + extra, audit + "K"))
        elif symbol in GIVEN:
            _offer(out, after, (cost + REROLE + extra, audit + "R"))
    return out


class Parse:
    """One conversation, row by row. emit(edit, turn, role, text): called for every edit, in order, once it is final."""

    def __init__(self, emit: Callable[[str, int | None, str, str | None], None]):
        self.emit, self.chart = emit, predicted({("Chat", n, 0): (0, "") for n in range(len(GRAMMAR["Chat"]))})
        self.rows: deque = deque()
        self.due, self.audit = "user", []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before, self.turns, self.first, self.last = None, 0, None, None

    def row(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.turns, self.first, self.last = self.turns + 1, turn if self.first is None else self.first, turn
        self.rows.append((turn, role, None if fault in ("blank", "duplicate") else text))
        chart = predicted(scanned(self.chart, role, fault))
        least = min(chart.values())[0]
        self.chart = {item: value for item, value in chart.items() if value[0] <= least + SLACK}
        audits = [audit for _, audit in self.chart.values()]
        if len(audits[0]) >= FLUSH:
            low, high = min(audits), max(audits)
            same = next((n for n, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
            if same:
                self._final(low[:same])
                self.chart = {item: (cost, audit[same:]) for item, (cost, audit) in self.chart.items()}

    def _final(self, edits: str) -> None:
        for edit in edits:
            turn, role, text = (None, "", "") if edit == "I" else self.rows.popleft()
            if edit in "IR":
                role = self.due
            if edit != "D":
                self.due = "assistant" if role[:1] == "u" else "user"
            self.emit(edit, turn, role, None if edit == "D" else text)
        self.audit.append(edits)

    def end(self) -> dict:
        """Counts, cost and audit of the whole conversation."""
        cost, audit = min(value for item, value in self.chart.items() if _symbol(item) == END)
        self._final(audit)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self.audit)}


def faulty(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone (MARK, if there is such), fault, dealt by conversation and sorted by row."""
    text, stops = F.col("text"), F.lit(" \t\n\x0b\f\r")
    end = F.rtrim(text, stops)
    wide = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.col(MARK) if MARK in rows.columns else F.lit(False)).alias("gone"),
    ).withColumn("end", F.substring(end, -1, 1))
    # One shuffle: rows of a conversation are in one place for the search of duplicates and for parsing.
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    fault = F.when(F.col("end") == "", "blank").when(F.row_number().over(seen) > 1, "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated").otherwise("")
    return wide.repartition("conv_id").withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "turn", "role", "text", "gone", "fault")


def _conversations(batches, sink: Callable) -> Iterator[tuple | None]:
    """(conv_id, summary, sink's value) for every conversation of sorted rows, and None after every batch; sink(conv_id) gives (emit, value)."""
    now: tuple | None = None
    parse = value = None
    for batch in batches:
        for conv, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now[0]:
                if now is not None:
                    yield now[0], parse.end(), value()
                now = (conv,)
                emit, value = sink(conv)
                parse = Parse(emit)
            if not gone:
                parse.row(turn, role, text, fault)
        yield None
    if now is not None:
        yield now[0], parse.end(), value()


def _digest(_conv):
    """A sink that hashes the turns that stay, as role:text, joined by newlines."""
    digest, first = hashlib.sha256(), [True]

    def emit(edit, turn, role, text):
        if edit != "D":
            digest.update((("" if first[0] else "\n") + f"{role}:{text}").encode("utf-8", "replace"))
            first[0] = False

    return emit, digest.hexdigest


REPORT = {"gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string"}


def _table(rows: list[tuple], kinds: dict[str, str]) -> pa.RecordBatch:
    made = {"bigint": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, made[k]) for c, k in zip(columns, kinds.values())], names=list(kinds))


def report(rows: DataFrame) -> DataFrame:
    """For every conversation of rows (conv_id, turn, role, text): what is wrong with it, the cost and the edits of its repair, and the digest of the repaired turns."""
    common.tune(rows.sparkSession)
    kinds = {"conv_id": "bigint", **REPORT, "repaired_sha256": "string"}

    def run(batches):
        out = []
        for found in _conversations(batches, _digest):
            if found is not None:
                conv, summary, digest = found
                out.append((conv, *[summary[k] for k in REPORT], digest))
            if len(out) >= 500:
                yield _table(out, kinds)
                out = []
        yield _table(out, kinds)

    return faulty(rows).mapInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of every conversation, in order: conv_id, step, edit (K, R, D, I), turn (null if inserted), role and text as repaired (text null if deleted)."""
    common.tune(rows.sparkSession)
    kinds = {"conv_id": "bigint", "step": "bigint", "edit": "string", "turn": "bigint", "role": "string", "text": "string"}

    def run(batches):
        out: list[tuple] = []

        def sink(conv):
            steps = iter(range(1 << 62))
            return lambda edit, turn, role, text: out.append((conv, next(steps), edit, turn, role, text)), lambda: None

        for _ in _conversations(batches, sink):
            if len(out) >= 500:
                yield _table(out, kinds)
                out.clear()
        yield _table(out, kinds)

    return faulty(rows).mapInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that the crc32 of `conv_id:turn` modulo 20 says: 0 drops (MARK), 1 empties, 2 takes the ends of sentences, 3 repeats, 4 makes the role user.

    Nulls are one space. Dropped rows stay as marks, so that a conversation that lost all of its rows is known.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    held = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("m"))
    m = F.col("m")
    text = F.when(m.isin(0, 1), "").when(m == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = held.select("conv_id", "turn", F.when(m.isin(0, 4), "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (m == 0).alias(MARK), F.explode(F.array_repeat(F.lit(0), F.when(m == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


def query(spark, sf_dir: str) -> DataFrame:
    return report(damaged(common.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


#: The same by steps over rows: for each state the cheapest edits, without a chart.
ORACLE = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), bits AS (SELECT n, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(n AS BIGINT)) AS v FROM range(256) t(n)
), tab AS (SELECT list(v ORDER BY n) AS t FROM bits
), k AS (
  SELECT o.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(t[CAST((xor(c, b) & 255) AS INTEGER) + 1], c // 256)), 4294967295) % 20 AS m FROM o, tab
), dam AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role, CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, range(2) c(n) WHERE m <> 0 AND (n = 0 OR m = 3)
), ord AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS r, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS e FROM dam
), f AS (
  SELECT *, CASE WHEN e = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN e NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         CASE WHEN i > 1 AND lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS bad FROM ord
), step(a, z, r, edit, c) AS (VALUES ('0', 's', 's', 'K', 0), ('0', 'u', 'u', 'K', 0), ('s', 'u', 'u', 'K', 0), ('a', 'u', 'u', 'K', 0), ('u', 'a', 'a', 'K', 0),
  ('0', 'u', '', 'R', 1), ('s', 'u', '', 'R', 1), ('a', 'u', '', 'R', 1), ('u', 'a', '', 'R', 1), ('0', '0', '', 'D', 2), ('s', 's', '', 'D', 2), ('a', 'a', '', 'D', 2), ('u', 'u', '', 'D', 2)
), ins(a, z, edit, c) AS (VALUES ('0', '0', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0), ('0', 'u', 'I', 5), ('s', 'u', 'I', 5), ('a', 'u', 'I', 5), ('u', 'a', 'I', 5), ('0', 'a', 'II', 10), ('s', 'a', 'II', 10)
), run AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, z AS st, CAST(c AS BIGINT) AS cost, CAST(ins.edit AS VARCHAR) AS audit FROM (SELECT DISTINCT conv_id FROM f), ins WHERE a = '0'
  UNION ALL
  SELECT conv_id, i, st, cost, audit FROM (
    SELECT run.conv_id, f.i, ins.z AS st, run.cost + step.c + ins.c + CASE WHEN f.fault = 't' AND step.edit <> 'D' THEN 5 ELSE 0 END AS cost, run.audit || step.edit || ins.edit AS audit
    FROM run JOIN f ON f.conv_id IS NOT DISTINCT FROM run.conv_id AND f.i = run.i + 1 JOIN step ON step.a = run.st JOIN ins ON ins.a = step.z
    WHERE CASE step.edit WHEN 'K' THEN f.r = step.r AND f.fault NOT IN ('b', 'd') WHEN 'R' THEN f.fault NOT IN ('b', 'd') ELSE true END
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1
), best AS (
  SELECT run.* FROM run JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM run.conv_id AND run.i = n WHERE st IN ('0', 'a')
  QUALIFY row_number() OVER (PARTITION BY run.conv_id ORDER BY cost, audit) = 1
), lt AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit, p - length(replace(substr(audit, 1, p), 'I', '')) AS skipped, length(replace(substr(audit, 1, p), 'D', '')) AS kept FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)
), ed AS (
  SELECT lt.*, f.role, f.text, CASE WHEN first_value(CASE WHEN lt.edit = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY lt.conv_id ORDER BY lt.p) = 1 THEN 1 ELSE 0 END AS s
  FROM lt LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM lt.conv_id AND lt.edit <> 'I' AND f.i = lt.p - lt.skipped WHERE lt.edit <> 'D'
), rep AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (kept - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h FROM ed GROUP BY conv_id
), stat AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, CAST(sum(bad) AS BIGINT) AS illegal FROM f GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN rep ON rep.conv_id IS NOT DISTINCT FROM c.conv_id
"""
