"""Decontamination against a search of every window in every text."""

import random
import re

import pytest

from clinlake.llm import decontamination

SCHEMA = "doc_id bigint, text string, item_id string, win string, hash bigint, size int, digest string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    wins = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), window)
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    found |= wins[tuple(w[i : i + size])]
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "É", "c1", "Dog", "über", "x", "年"])
    body = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, body(rng.randint(10, 25))) for i in range(12)] + [(20, "Short one, here"), (21, "alone"), (22, ""), (None, None), (None, "no id at all"), (3, body(14))]
    items += [items[0], (30, items[1][1]), (31, "aa bb cc dd ee ff gg hh ii jj kk")]
    docs = [(n, body(rng.randint(0, 80))) for n in range(40)]
    docs += [(100 + n, f"{body(5)} {items[n][1].upper()} {body(rng.randint(0, 9))}") for n in range(12)]
    docs += [(200, None), (201, ""), (None, items[2][1]), (202, " ".join(words(items[4][1])[:10])), (203, " ".join(words(items[4][1])[1:10])), (204, "SHORT one: here, alone!"), (205, "shortone here")]
    docs += [(206, f"{items[5][1]} " * 40), (207, items[5][1] + " " + body(30_000)), (208, "aa bb cc dd ee ff gg hh ii jj"), (209, "bb cc dd ee ff gg hh ii jj"), docs[41]] + [(300 + n, docs[42][1]) for n in range(20)]
    return docs, items


@pytest.mark.parametrize("window,shingle,block", [(10, 5, 1 << 20), (10, 5, 20), (6, 2, 1 << 20), (4, 5, 7)])
def test_hits_are_those_of_a_full_search(spark, tables, window, shingle, block):
    docs, items = tables
    wide = spark.createDataFrame([(d, t, "c", "w", 1, 2, "x") for d, t in docs], SCHEMA).repartition(4)
    bench = spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id bigint, text string, start int, pos string")
    got = sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontamination.judge(wide, bench, window, shingle, block).collect()], key=str)
    assert got == brute(docs, items, window)


def test_empty_tables(spark, tables):
    docs, items = tables
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.judge(spark.createDataFrame([], "doc_id bigint, text string"), bench).count() == 0
    got = decontamination.judge(spark.createDataFrame(docs, "doc_id bigint, text string"), none).collect()
    assert len(got) == len(docs) and not any(r.contaminated or r.n_hit or r["items"] for r in got)


def test_only_rare_prefixes_are_joined(spark):
    """Of a window whose first shingle is common and last one is rare, only the rare one makes candidates."""
    common_part, rare = "one two three four five six", "seven eight nine ten"
    docs = [(n, f"{common_part} and other words {n}") for n in range(50)] + [(99, f"{common_part} {rare}")]
    wins = decontamination.windows(spark.createDataFrame([(1, f"{common_part} {rare}")], "item_id bigint, text string"))
    shingled = decontamination.shingles(wins)
    met = decontamination.occurrences(spark.createDataFrame(docs, "doc_id bigint, text string"), shingled.select("hash").distinct(), [5])
    counts = met.groupBy("hash").count().withColumnRenamed("count", "n_occurrences")
    prefix = decontamination.prefixes(shingled, counts).collect()
    assert [p["at"] for p in prefix][0] >= 2 and len(prefix) == 1
    assert met.filter(met["hash"] == prefix[0]["hash"]).count() == 1 < met.count()
