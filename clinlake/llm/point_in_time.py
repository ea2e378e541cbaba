"""Point-in-time features of a shop's clients by merge-sort trees.

A row that happened at e and is known from v on (v >= e: what is known later than it happened waits for that) counts for a
time t and a window of d where t - d < e <= t and v <= t. For every client there is a tree over event time: its dyadic
blocks hold their rows sorted by v, with prefix sums of all measures and the prefix maximum of the latest click. A probe
explodes its window into blocks and finds its place in each by binary search.

The tree has two parts. Event time is cut into slabs of 2**level microseconds. Inside of a slab the blocks are over the
ranks of its rows, so a window's ends are met exactly (`answers`, numpy over the slabs that Spark has dealt to a task). Slabs that
lie wholly inside of a window are merged into dyadic blocks of slabs, made by Spark: a window that holds such a block
ends after it, so all rows known by the block's end are one sum, made before the shuffle, and only later ones are kept apart.

Skew: rows of equal (client, e, v) are one entry. A client's level follows from its fullest stretch of 2**TALL microseconds, so that
a slab holds about TARGET entries; blocks of slabs go up to 2**TALL (38 hours), and a window takes several of these. Clients with a
level of their own are broadcast if they are few (counted), or else by `common.keyed_join`. A task streams its blocks: it holds the
entries of one block and a piece of the probes. Nothing goes to the driver but counts.

Distinct items: of the rows of a client and an item, in the order of v, a row matters only if its e is later than those
before it; it then takes over from them at max(v, their latest e + d). These rows are entries like others, one for each d, of
which no two are counted together. The order is found in stretches of 2**CHUNK microseconds, and what comes before a stretch is
carried into it, so a common item of a busy client is not one task.

Times without a zone are UTC; others are instants. Nulls: a sale without client or time gives no result and counts nowhere; a null
arrival or shipping time is never known; a null amount is 0 cents; clicks without an id are before others of their
time; lines without an item count, but not as an item; a null sale_id has the decimal text of no digits, and no lines. Fully equal clicks
(all columns) count once. Each of repeated sales is a result, and counts; lines count for each of them. Ties are settled as said. Texts (props) are compared as a whole, however
long. An empty table gives no results or zeros. Extra columns are left out, but tell clicks apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import common

SECOND = 1_000_000
DAY = 86_400 * SECOND
#: Days of the windows, and of the label's window after t.
WINDOWS, LABEL = (2, 14), 7
#: From its arrival to its being known, a row takes so long.
DELAY = 240 * 60 * SECOND
#: Seconds after a sale within which its time t is.
SPREAD = 259_200
#: Entries of a slab, about. Widest slab, highest blocks of slabs, and their levels above a slab, as powers of two of microseconds.
TARGET, WIDE, TALL, RISE = 8_000, 42, 37, 8
#: Stretches in which distinct items are put into order.
CHUNK = 34
#: Rows that a task works on at once.
ROWS = 200_000
NEVER = 1 << 61

COUNTED = ("n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "line_cents")
MEASURES = (*COUNTED, "items_2", "items_14", "sold")
BLOCK = ("client_id", "level", "idx")


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a time without a zone is UTC, whatever the session's zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(c)
    c = c.cast("timestamp_ntz")
    seconds = F.unix_date(c.cast("date")).cast("bigint") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return seconds * SECOND + (F.extract(F.lit("SECOND"), c) * SECOND).cast("bigint")


def cents(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(F.isnan(x) | x.isNull(), F.lit(0).cast("bigint")).otherwise(F.floor(100 * x + 0.5))


def _entry(df: DataFrame, click: Column | None = None, **measures: Column) -> DataFrame:
    """client_id, e, v, click and all measures; those that are not given are 0."""
    zero = F.lit(0).cast("bigint")
    return df.select("client_id", "e", "v", (F.lit(None) if click is None else click).cast("bigint").alias("click"), *[measures.get(m, zero).cast("bigint").alias(m) for m in MEASURES])


def _seen(df: DataFrame) -> DataFrame:
    """Rows that any window can hold."""
    return df.filter(F.col("v") < F.col("e") + max(WINDOWS) * DAY)


def _clicks(clicks: DataFrame) -> DataFrame:
    e, known = micros(clicks, "ts"), micros(clicks, "arrived_at") + DELAY
    rows = clicks.distinct().withColumns({"e": e, "v": F.when(known.isNotNull(), F.greatest(e, known)), "client_id": F.col("client_id").cast("bigint")})
    rows = _seen(rows.filter(F.col("client_id").isNotNull() & F.col("e").isNotNull()))
    one = F.lit(1)
    return _entry(rows, F.col("click_id"), n_clicks=one, n_purchases=F.coalesce(F.col("kind") == "purchase", F.lit(False)), click_cents=cents("value"))


def _sales(sales: DataFrame) -> DataFrame:
    """sale_id, client_id, e, known, cents of the sales that have a client and a time."""
    rows = sales.select(F.col("sale_id").cast("bigint").alias("sale_id"), F.col("client_id").cast("bigint").alias("client_id"), micros(sales, "sold_at").alias("e"), (micros(sales, "arrived_at") + DELAY).alias("known"), cents("total").alias("cents"))
    return rows.filter(F.col("client_id").isNotNull() & F.col("e").isNotNull())


def _sold(sold: DataFrame) -> DataFrame:
    """Every sale is an entry, as labels count it whenever it arrives."""
    v = F.when(F.col("known").isNotNull(), F.greatest("e", "known")).otherwise(F.lit(NEVER))
    return _entry(sold.withColumn("v", v), sold=F.lit(1), n_sales=F.lit(1), sale_cents=F.col("cents"))


def known_lines(lines: DataFrame, sold: DataFrame) -> DataFrame:
    """client_id, item_id, e, v, n, cents: lines of known sales; equal ones are put together where they are read."""
    rows = lines.select(F.col("sale_id").cast("bigint").alias("sale_id"), F.col("item_id").cast("bigint").alias("item_id"), micros(lines, "shipped_at").alias("shipped"), cents("amount").alias("cents"))
    # An inner join that AQE can split where one sale has many lines.
    rows = rows.filter("shipped is not null").join(sold.filter("known is not null").select("sale_id", "client_id", "e", "known"), "sale_id")
    rows = _seen(rows.withColumn("v", F.greatest("e", "known", "shipped")))
    return rows.groupBy("client_id", "item_id", "e", "v").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


def _lines(known: DataFrame) -> DataFrame:
    """Entries of lines, and of the items that they make distinct."""
    rows = known.withColumn("chunk", F.shiftright("v", CHUNK))
    inside = Window.partitionBy("client_id", "item_id", "chunk").orderBy("v", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("prev", F.max("e").over(inside))
    tops = rows.filter("item_id is not null").groupBy("client_id", "item_id", "chunk").agg(F.max("e").alias("top"))
    before = Window.partitionBy("client_id", "item_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.withColumn("carry", F.max("top").over(before)).filter("carry is not null").drop("top")
    rows = rows.join(carried, ["client_id", "item_id", "chunk"], "left").withColumn("prev", F.greatest("prev", "carry"))
    new = F.col("item_id").isNotNull() & (F.col("prev").isNull() | (F.col("e") > F.col("prev")))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    first, later = {}, []
    for d in WINDOWS:
        takes = F.greatest(F.col("v"), F.col("prev") + d * DAY)
        counts = new & (takes < F.col("e") + d * DAY)
        first[d] = F.when(counts & (takes == F.col("v")), one).otherwise(zero)
        late = F.struct(takes.alias("v"), zero.alias("n"), zero.alias("cents"), *[(one if d == x else zero).alias(f"i{x}") for x in WINDOWS])
        later.append(F.when(counts & (takes > F.col("v")), late))
    points = F.array_compact(F.array(F.struct("v", "n", "cents", *[first[d].alias(f"i{d}") for d in WINDOWS]), *later))
    flat = rows.select("client_id", "e", F.explode(points).alias("p")).select("client_id", "e", "p.*")
    return _entry(flat, n_lines=F.col("n"), line_cents=F.col("cents"), items_2=F.col("i2"), items_14=F.col("i14"))


def entries(clicks: DataFrame, sales: DataFrame, lines: DataFrame) -> DataFrame:
    """client_id, e, v, click, measures: what happened to clients, one row for each (client_id, e, v)."""
    sold = _sales(sales)
    known = common.materialize(known_lines(lines, sold), "lines")
    rows = _clicks(clicks).unionByName(_sold(sold)).unionByName(_lines(known))
    return rows.groupBy("client_id", "e", "v").agg(F.max("click").alias("click"), *[F.sum(m).alias(m) for m in MEASURES])


def probes(sales: DataFrame) -> DataFrame:
    """sale_id, client_id, t, copies: the times at which features are asked for."""
    key = F.coalesce(F.col("sale_id").cast("string"), F.lit(""))
    rows = _sales(sales).select("sale_id", "client_id", (F.col("e") + (F.crc32(key.cast("binary")) % SPREAD) * SECOND).alias("t"))
    return rows.groupBy("sale_id", "client_id", "t").agg(F.count("*").alias("copies"))


def levels(happened: DataFrame, asked: DataFrame, target: int = TARGET) -> DataFrame:
    """s_client, s_level, s_rows: clients whose slabs have to be narrower than the widest, by their fullest stretch."""
    at = lambda df, c: df.select("client_id", F.shiftright(c, TALL).alias("stretch"))
    full = at(happened, "e").unionByName(at(asked, "t")).groupBy("client_id", "stretch").agg(F.count("*").alias("n"))
    busy = full.groupBy(F.col("client_id").alias("s_client")).agg(F.max("n").alias("most"), F.sum("n").alias("s_rows"))
    level = WIDE - F.ceil(F.log2(F.col("most") * float(1 << (WIDE - TALL)) / target))
    return busy.select("s_client", F.greatest(level, F.lit(0)).cast("int").alias("s_level"), "s_rows").filter(F.col("s_level") < WIDE)


def _levelled(rows: DataFrame, split: DataFrame, small: bool, total: int) -> DataFrame:
    """Rows with the level of their client's slabs, and of its highest blocks."""
    if small:
        out = rows.join(F.broadcast(split), F.col("client_id") == F.col("s_client"), "left")  # counted before
    else:
        out = common.keyed_join(rows, split, [("client_id", "s_client")], "s_rows", total)
    out = out.withColumn("level", F.coalesce("s_level", F.lit(WIDE))).drop("s_client", "s_level", "s_rows")
    return out.withColumn("top", F.greatest("level", F.least(F.lit(TALL), F.col("level") + RISE)))


def _blocks_of_slabs(rows: DataFrame) -> DataFrame:
    """Entries of blocks of slabs: what is known by the end of a block is one row of it."""
    up = rows.filter("top > level").withColumn("level", F.explode(F.expr("sequence(level + 1, top)")))
    up = up.withColumn("idx", F.expr("shiftright(e, level)"))
    up = up.withColumn("v", F.greatest("v", F.expr("shiftleft(idx + 1, level) - 1")))
    last = F.max(F.when(F.col("n_clicks") > 0, F.struct("e", "click")))
    out = up.groupBy(*BLOCK, "v").agg(last.alias("last"), *[F.sum(m).alias(m) for m in MEASURES])
    return out.withColumns({"e": F.coalesce("last.e", F.expr("shiftleft(idx, level)")), "click": F.col("last.click")}).drop("last")


def _exploded(asked: DataFrame) -> DataFrame:
    """Windows of every probe, exploded into the slabs at their ends and dyadic blocks of slabs between."""
    t = F.col("t")
    spans = [F.struct(F.lit(d).alias("w"), (t - d * DAY + 1).alias("lo"), t.alias("hi"), t.alias("v")) for d in WINDOWS]
    spans.append(F.struct(F.lit(LABEL).alias("w"), (t + 1).alias("lo"), (t + LABEL * DAY).alias("hi"), F.lit(NEVER).alias("v")))
    rows = asked.withColumn("s", F.explode(F.array(*spans))).select("sale_id", "client_id", "t", "copies", "level", "top", "s.*")
    rows = rows.withColumns({"first": F.expr("shiftright(lo, level)"), "last": F.expr("shiftright(hi, level)")})
    a, b = "shiftright(first + shiftleft(1L, k), k)", "shiftright(last, k)"
    block = lambda at: f"struct(cast(level + k as int) as level, {at} as idx)"
    between = f"""flatten(transform(sequence(0, top - level), k -> if({a} >= {b}, array(), if(k = top - level,
        transform(sequence({a}, {b} - 1), x -> {block('x')}),
        array_compact(array(if({a} & 1 = 1, {block(a)}, null), if({b} & 1 = 1, {block(f'{b} - 1')}, null)))))))"""
    ends = "if(first = last, array(struct(level as level, first as idx)), array(struct(level as level, first as idx), struct(level as level, last as idx)))"
    blocks = F.expr(f"if(last - first < 2, {ends}, concat({ends}, {between}))")
    return rows.withColumn("b", F.explode(blocks)).select("client_id", "b.level", "b.idx", "lo", "hi", "v", "sale_id", "t", "w", "copies")


def answers(block: np.ndarray, e: np.ndarray, v: np.ndarray, measures: np.ndarray, clicked: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the measures, and the place of the last clicked entry or -1, for every probe.

    Entries (block, e, v) are sorted by block, e and click. A probe asks block `of` for entries with lo <= e <= hi and v <= seen. Level k of the tree
    has 2**k neighbouring entries in a block, sorted by v; a probe takes two blocks of a level at most.
    """
    n, places = len(e), np.arange(len(e))
    times, known = np.unique(e), np.unique(v)
    width, deep = len(times) + 1, len(known) + 1
    at = block * width + np.searchsorted(times, e)
    left = np.searchsorted(at, of * width + np.searchsorted(times, lo))
    right = np.searchsorted(at, of * width + np.searchsorted(times, hi, "right"))
    rank, bound = np.searchsorted(known, v), np.searchsorted(known, seen, "right")
    sums, best = np.zeros((len(of), measures.shape[1]), np.int64), np.full(len(of), -1, np.int64)
    last, level = np.where(clicked, places, -1), 0
    while (still := left < right).any():
        takes = [(w, x) for w, x in ((still & (left & 1 == 1), left), (still & (right & 1 == 1), right - 1)) if w.any()]
        if takes:
            own = places >> level
            key = own * deep + rank
            order = np.argsort(key, kind="stable")
            key = key[order]
            prefix = np.zeros((n + 1, measures.shape[1]), np.int64)
            np.cumsum(measures[order], axis=0, out=prefix[1:])
            latest = np.maximum.accumulate(own * (n + 1) + last[order] + 1)
            for which, x in takes:
                node = x[which]
                found, begin = np.searchsorted(key, node * deep + bound[which]), node << level
                sums[which] += prefix[found] - prefix[begin]
                top = np.where(found > begin, latest[found - 1] - node * (n + 1) - 1, -1)
                best[which] = np.maximum(best[which], top)
        left, right = (left + (left & 1)) >> 1, right >> 1
        level += 1
    return sums, best


ANSWER = ("sale_id", "client_id", "t", "w", "copies", *COUNTED, "n_items", "sold", "last_e", "last_click")


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks, entries before probes, to the answers of the probes."""
    held: pa.Table | None = None
    waiting, rows = [], 0

    def work(table: pa.Table) -> tuple[pa.RecordBatch | None, pa.Table]:
        num = lambda c: table.column(c).to_numpy()
        keys = [num(c) for c in BLOCK]
        new = np.zeros(table.num_rows, np.int64)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        block, kind = np.cumsum(new), num("kind")
        entry = kind == 0
        keep = table.filter(pa.array(entry & (block == block[-1])))
        if entry.all():
            return None, keep
        ask = table.filter(pa.array(~entry))
        told = table.filter(pa.array(entry))
        measures = np.stack([told.column(m).to_numpy() for m in MEASURES], axis=1) if told.num_rows else np.zeros((0, len(MEASURES)), np.int64)
        e = told.column("lo").to_numpy()
        sums, best = answers(block[entry], e, told.column("v").to_numpy(), measures, measures[:, 0] > 0, block[~entry], *[ask.column(c).to_numpy() for c in ("lo", "hi", "v")])
        w = ask.column("w").to_numpy()
        out = {c: ask.column(c).combine_chunks() for c in ("sale_id", "client_id", "t", "w", "copies")}
        out |= {m: pa.array(sums[:, i]) for i, m in enumerate(COUNTED)}
        out |= {"n_items": pa.array(np.where(w == WINDOWS[0], sums[:, 7], sums[:, 8])), "sold": pa.array(sums[:, 9])}
        none = best < 0
        places = pa.array(np.where(none, 0, best), mask=none)
        out |= {"last_e": told.column("lo").combine_chunks().take(places), "last_click": told.column("sale_id").combine_chunks().take(places)}
        return pa.record_batch([out[c] for c in ANSWER], names=list(ANSWER)), keep

    def flush():
        nonlocal held, waiting, rows
        batch, held = work(pa.Table.from_batches(([] if held is None else held.to_batches()) + waiting))
        waiting, rows = [], 0
        return batch

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        if rows >= ROWS and (done := flush()) is not None:
            yield done
    if waiting and (done := flush()) is not None:
        yield done


def features(clicks: DataFrame, sales: DataFrame, lines: DataFrame, target: int = TARGET) -> DataFrame:
    """sale_id, d, t_us, label and the features of every sale with a client and a time, for each window of d days."""
    happened = common.materialize(entries(clicks, sales, lines), "entries")
    asked = common.materialize(probes(sales), "probes")
    split = common.materialize(levels(happened, asked, target), "levels")
    small, total = common.is_small(split), happened.count()
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    held = _levelled(happened, split, small, total)
    slabs = held.withColumn("idx", F.expr("shiftright(e, level)"))
    columns = [*BLOCK, F.lit(0).alias("kind"), F.col("e").alias("lo"), F.col("click").alias("sale_id"), "v", zero.alias("hi"), zero.alias("t"), F.lit(0).alias("w"), zero.alias("copies"), *MEASURES]
    told = slabs.select(*columns).unionByName(_blocks_of_slabs(held).select(*columns))
    ask = _exploded(_levelled(asked, split, small, total)).select(*BLOCK, F.lit(1).alias("kind"), "lo", "sale_id", "v", "hi", "t", "w", "copies", *[zero.alias(m) for m in MEASURES])
    dealt = told.unionByName(ask).repartition(*BLOCK).sortWithinPartitions(*BLOCK, "kind", "lo", "sale_id")
    got = dealt.mapInArrow(_answered, ", ".join(f"{c} {'int' if c == 'w' else 'bigint'}" for c in ANSWER))
    mine = lambda d, x: F.when(F.col("w") == d, x)
    sums = [F.coalesce(F.sum(mine(d, F.col(m))), zero).alias(f"{m}_{d}") for d in WINDOWS for m in (*COUNTED, "n_items")]
    last = [F.max(mine(d, F.when(F.col("last_e").isNotNull(), F.struct("last_e", "last_click")))).alias(f"last_{d}") for d in WINDOWS]
    label = F.max(F.coalesce(mine(LABEL, F.col("sold") > 0), F.lit(False))).alias("label")
    wide = got.groupBy("sale_id", "client_id", "t").agg(F.max("copies").alias("copies"), label, *sums, *last)
    each = [F.struct(F.lit(d).alias("d"), *[F.col(f"{m}_{d}").alias(m) for m in (*COUNTED, "n_items")], F.col(f"last_{d}.last_click").alias("last_click_id")) for d in WINDOWS]
    rows = wide.select("sale_id", F.col("t").alias("t_us"), "label", F.explode(F.flatten(F.array_repeat(F.array(*each), F.col("copies").cast("int")))).alias("f"))
    shown = ("n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents")
    return rows.select("sale_id", "f.d", "t_us", "label", *[f"f.{c}" for c in shown])


def query(spark, sf_dir: str) -> DataFrame:
    return features(*[common.read(spark, sf_dir, t) for t in ("clicks", "sales", "sale_lines")])


ORACLE = r"""
WITH bits AS (SELECT n, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(n AS BIGINT)) AS v FROM range(256) t(n)
), tab AS (SELECT list(v ORDER BY n) AS t FROM bits
), s AS (
  SELECT row_number() OVER () AS r, sale_id, client_id, epoch_us(sold_at) AS e, epoch_us(arrived_at) + 14400000000 AS known, CAST(floor(100 * coalesce(total, 0) + 0.5) AS BIGINT) AS cents,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(sale_id AS VARCHAR), ''), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda c, b: xor(t[CAST((xor(c, b) & 255) AS INTEGER) + 1], c // 256)), 4294967295) % 259200 AS m
  FROM sales, tab WHERE client_id IS NOT NULL AND sold_at IS NOT NULL
), c AS (
  SELECT click_id, client_id, epoch_us(ts) AS e, epoch_us(arrived_at) + 14400000000 AS known, kind, CAST(floor(100 * coalesce(value, 0) + 0.5) AS BIGINT) AS cents FROM (SELECT DISTINCT * FROM clicks)
), p AS (SELECT r, sale_id, client_id, e + m * 1000000 AS t, d FROM s, (VALUES (2), (14)) w(d)
), pc AS (
  SELECT p.r, p.d, count(*) AS n_clicks, count(*) FILTER (WHERE kind = 'purchase') AS n_purchases, CAST(sum(cents) AS BIGINT) AS click_cents, first(click_id ORDER BY c.e DESC, click_id DESC NULLS LAST) AS last_click_id
  FROM p JOIN c ON p.client_id = c.client_id AND c.e > p.t - p.d * 86400000000 AND c.e <= p.t AND c.known <= p.t GROUP BY p.r, p.d
), ps AS (
  SELECT p.r, p.d, p.t, s.sale_id, s.cents FROM p JOIN s ON p.client_id = s.client_id AND s.e > p.t - p.d * 86400000000 AND s.e <= p.t AND s.known <= p.t
), pa AS (SELECT r, d, count(*) AS n_sales, CAST(sum(cents) AS BIGINT) AS sale_cents FROM ps GROUP BY r, d
), pl AS (
  SELECT ps.r, ps.d, count(*) AS n_lines, count(DISTINCT item_id) AS n_items, CAST(sum(CAST(floor(100 * coalesce(amount, 0) + 0.5) AS BIGINT)) AS BIGINT) AS line_cents
  FROM ps JOIN sale_lines l ON l.sale_id = ps.sale_id AND epoch_us(l.shipped_at) <= ps.t GROUP BY ps.r, ps.d
), lab AS (SELECT DISTINCT p.r FROM p JOIN s ON p.client_id = s.client_id AND s.e > p.t AND s.e <= p.t + 7 * 86400000000)
SELECT p.sale_id, CAST(p.d AS INTEGER) AS d, p.t AS t_us, lab.r IS NOT NULL AS label, coalesce(n_clicks, 0) AS n_clicks, coalesce(n_purchases, 0) AS n_purchases, coalesce(click_cents, 0) AS click_cents, last_click_id,
       coalesce(n_sales, 0) AS n_sales, coalesce(sale_cents, 0) AS sale_cents, coalesce(n_lines, 0) AS n_lines, coalesce(n_items, 0) AS n_items, coalesce(line_cents, 0) AS line_cents
FROM p LEFT JOIN lab ON lab.r = p.r LEFT JOIN pc ON pc.r = p.r AND pc.d = p.d LEFT JOIN pa ON pa.r = p.r AND pa.d = p.d LEFT JOIN pl ON pl.r = p.r AND pl.d = p.d
"""
