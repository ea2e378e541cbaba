"""Point-in-time features against a count of all rows for every sale."""

import datetime as dt
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import point_in_time

BASE = dt.datetime(2024, 1, 1)
CLICKS = "click_id bigint, ts timestamp_ntz, arrived_at timestamp_ntz, client_id bigint, kind string, value double, props string, e bigint, level int"
SALES = "sale_id bigint, client_id bigint, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, t bigint, copies int"
LINES = "sale_id bigint, line_no int, item_id bigint, vendor_id bigint, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, v bigint"


def us(t):
    return None if t is None else (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def cents(x):
    return 0 if x is None else math.floor(100 * x + 0.5)


def brute(clicks, sales, lines):
    day, delay = 86_400_000_000, 240 * 60_000_000
    clicks = list(dict.fromkeys(clicks))
    out = []
    for s in sales:
        if s[1] is None or s[4] is None:
            continue
        t = us(s[4]) + zlib.crc32(("" if s[0] is None else str(s[0])).encode()) % 259_200 * 1_000_000
        mine = [x for x in sales if x[1] == s[1] and x[4] is not None]
        label = any(t < us(x[4]) <= t + 7 * day for x in mine)
        for d in (2, 14):
            inside = lambda e, a: e is not None and a is not None and t - d * day < us(e) <= t and us(a) + delay <= t
            seen = [c for c in clicks if c[3] == s[1] and inside(c[1], c[2])]
            sold = [x for x in mine if inside(x[4], x[5])]
            held = [x for y in sold for x in lines if y[0] is not None and x[0] == y[0] and x[8] is not None and us(x[8]) <= t]
            last = max(seen, key=lambda c: (c[1], -1 if c[0] is None else c[0]), default=(None,))[0]
            out.append((s[0], d, t, label, len(seen), sum(c[4] == "purchase" for c in seen), sum(cents(c[5]) for c in seen), last, len(sold), sum(cents(x[3]) for x in sold),
                        len(held), len({x[2] for x in held if x[2] is not None}), sum(cents(x[5]) for x in held)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def shop():
    rng = random.Random(13)
    at = lambda days: BASE + dt.timedelta(microseconds=rng.randrange(int(days * 86_400_000_000)))
    client = lambda: 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, None])
    clicks, sales, lines = [], [], []
    for n in range(500):
        ts = at(40) if rng.random() < 0.8 else BASE + dt.timedelta(days=rng.randrange(30))
        late = dt.timedelta(seconds=rng.choice([1, 60, 5_000, 300_000, 2_000_000, -3_600]))
        clicks.append((n if n % 50 else None, None if n % 41 == 0 else ts, None if n % 67 == 0 else ts + late, client(), rng.choice(["view", "purchase", None]), rng.choice([None, 1.005, -2.5, 17.0, 0.125]), '{"k": 1}', 1, 2))
    clicks += clicks[:40] + [(900 + n, BASE + dt.timedelta(days=9), BASE + dt.timedelta(days=9), 1, "view", 2.0, "x" * (9 if n else 100_000), 1, 2) for n in range(5)]
    for n in range(160):
        sold = at(40) if rng.random() < 0.7 else BASE + dt.timedelta(days=rng.randrange(30))
        sales.append((n if n % 60 else None, client(), "done", rng.choice([None, 9.99, 120.5]), None if n % 37 == 0 else sold, None if n % 29 == 0 else sold + dt.timedelta(hours=rng.choice([0, 1, 30, 400])), 1, 1, 1))
    sales += [sales[5], sales[8], sales[8]]
    for n in range(700):
        sale = 8 if rng.random() < 0.3 else rng.choice([*range(160), None, 999])
        lines.append((sale, n, rng.choice([1, 1, 1, 2, 3, 4, None, rng.randrange(40)]), 1, 1, rng.choice([None, 3.333, 10.0]), 0.0, "f", None if n % 31 == 0 else at(45) if n % 2 else BASE + dt.timedelta(days=rng.randrange(45)), 7))
    lines += lines[:30]
    return clicks, sales, lines


@pytest.fixture(scope="module")
def tables(spark, shop):
    return [spark.createDataFrame(rows, kind).repartition(3) for rows, kind in zip(shop, (CLICKS, SALES, LINES))]


SHOWN = "sale_id d t_us label n_clicks n_purchases click_cents last_click_id n_sales sale_cents n_lines n_items line_cents".split()


@pytest.mark.parametrize("target,rows,chunk", [(8_000, 200_000, 34), (4, 37, 36), (1, 5, 40), (40, 1_000, 44)])
def test_features_are_those_of_a_full_count(spark, shop, tables, monkeypatch, target, rows, chunk):
    """Also with slabs so narrow that windows take many dyadic blocks, and pieces of a few rows."""
    monkeypatch.setattr(point_in_time, "CHUNK", chunk)
    answered = point_in_time._answered

    def small(batches):
        point_in_time.ROWS = rows
        cut = (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))
        yield from answered(cut)

    monkeypatch.setattr(point_in_time, "_answered", small)
    got = point_in_time.features(*tables, target=target).select(*SHOWN).collect()
    assert sorted(map(tuple, got), key=str) == brute(*shop)


def test_shuffled_levels_give_the_same(spark, shop, tables, monkeypatch):
    monkeypatch.setattr(point_in_time.common, "is_small", lambda df: False)
    monkeypatch.setattr(point_in_time.common, "MAX_BROADCAST_ROWS", 3)
    got = point_in_time.features(*tables, target=4).select(*SHOWN).collect()
    assert sorted(map(tuple, got), key=str) == brute(*shop)


def test_times_do_not_depend_on_the_session(spark, tables):
    at = lambda: [tuple(r) for r in tables[0].select("click_id", point_in_time.micros(tables[0], "ts").alias("t")).orderBy("click_id", "t").collect()]
    utc, zone = at(), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert at() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_instants_are_taken_as_they_are(spark, tables):
    """Tables whose times have a zone give the same features, in any session."""
    zoned = [t.withColumns({c: F.timestamp_micros(point_in_time.micros(t, c)) for c, kind in t.dtypes if kind == "timestamp_ntz"}) for t in tables]
    assert [dict(t.dtypes)[c] for t, c in zip(zoned, ("ts", "sold_at", "shipped_at"))] == ["timestamp"] * 3
    for plain, other in zip(tables, zoned):
        for c, kind in plain.dtypes:
            if kind == "timestamp_ntz":
                at = lambda t: sorted(str(r[0]) for r in t.select(point_in_time.micros(t, c)).collect())  # noqa: B023, E731
                assert at(plain) == at(other)


def test_empty_tables(spark, shop):
    none = [spark.createDataFrame([], kind) for kind in (CLICKS, SALES, LINES)]
    assert point_in_time.features(*none).count() == 0
    sales = spark.createDataFrame(shop[1], SALES)
    got = point_in_time.features(none[0], sales, none[2]).select(*SHOWN).collect()
    assert sorted(map(tuple, got), key=str) == brute([], shop[1], [])


def test_answers_of_random_trees():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 200):
        block = np.sort(rng.integers(0, 5, n))
        e = rng.integers(-20, 20, n)
        order = np.lexsort((e, block))
        block, e = block[order], e[order]
        v, m, clicked = e + rng.integers(0, 30, n), rng.integers(-5, 9, (n, 2)), rng.random(n) < 0.5
        of, lo, seen = rng.integers(0, 6, 300), rng.integers(-25, 25, 300), rng.integers(-25, 50, 300)
        hi = lo + rng.integers(0, 30, 300)
        sums, best = point_in_time.answers(block, e, v, m, clicked, of, lo, hi, seen)
        for i in range(300):
            held = np.flatnonzero((block == of[i]) & (e >= lo[i]) & (e <= hi[i]) & (v <= seen[i]))
            assert (sums[i] == m[held].sum(axis=0)).all()
            assert best[i] == max([x for x in held if clicked[x]], default=-1)


def test_hot_rows_are_few_entries(spark):
    """Lines of one sale that are known at one time are one entry, whatever their number."""
    sold = spark.createDataFrame([(1, 5, 0, 0, 0)], "sale_id bigint, client_id bigint, e bigint, known bigint, cents bigint")
    lines = spark.range(3_000).select(F.lit(1).alias("sale_id"), (F.col("id") % 7).alias("item_id"), F.lit(BASE).cast("timestamp_ntz").alias("shipped_at"), F.lit(1.0).alias("amount"))
    assert point_in_time.known_lines(lines, sold.withColumn("e", F.lit(us(BASE)))).count() == 7
