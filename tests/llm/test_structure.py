"""Repair of conversations against all edits that there are."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from clinlake.llm import structure

SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, gone string, fault string, copy int"


def marked(turns):
    """Rows in order with their faults, from (turn, role, text)."""
    out, seen = [], set()
    for _, role, text in turns:
        end = text.rstrip(SPACE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows, most=3):
    """(cost, audit, turns) by trying all edits with up to `most` insertions."""
    best = None
    for n in range(most + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for kinds in itertools.product("DKR", repeat=len(rows)):
                for roles in itertools.product("ua", repeat=kinds.count("R") + n):
                    cost, audit, turns, given = 0, "", [], iter(roles)
                    for i in range(len(rows) + 1):
                        for _ in range(places.count(i)):
                            cost, audit = cost + 5, audit + "I"
                            turns.append(({"u": "user", "a": "assistant"}[next(given)], ""))
                        if i == len(rows):
                            break
                        role, text, fault = rows[i]
                        audit += kinds[i]
                        if kinds[i] == "D":
                            cost += 2
                            continue
                        if fault in ("blank", "duplicate"):
                            cost = None
                            break
                        cost += (kinds[i] == "R") + 5 * (fault == "truncated")
                        turns.append((role if kinds[i] == "K" else {"u": "user", "a": "assistant"}[next(given)], text))
                    if cost is None or (best and (cost, audit) >= best[:2]) or not re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)):
                        continue
                    best = (cost, audit, turns)
    return best


def expected(conv):
    rows = sorted(conv, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = marked(rows)
    cost, audit, turns = brute(faults)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    count = lambda f: sum(x == f for _, _, x in faults)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(11)
    out = {}
    for n in range(60):
        rows = []
        for k in range(rng.randint(1, 4)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut", "", " \n", None, "é?", "Why?\n", f"text {k}.", " "])
            rows.append((None if rng.random() < 0.1 else k if rng.random() < 0.8 else k + 2, role, text))
        out[n if n != 7 else None] = rows
    return out


def test_report_is_the_cheapest_repair(spark, conversations):
    rows = [(c, t, r, x, "g", "f", 1) for c, turns in conversations.items() for t, r, x in turns]
    got = {r.conv_id: tuple(r)[1:] for r in structure.report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert set(got) == set(conversations)
    for conv, turns in conversations.items():
        assert got[conv] == expected([(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]), turns


def test_repaired_turns_give_the_digest(spark, conversations):
    rows = spark.createDataFrame([(c, t, r, x) for c, turns in conversations.items() for t, r, x in turns], "conv_id bigint, turn bigint, role string, text string")
    turns = {}
    for r in sorted(structure.repaired(rows).collect(), key=lambda r: r.step):
        turns.setdefault(r.conv_id, []).append(r)
    for r in structure.report(rows).collect():
        mine = turns.get(r.conv_id, [])
        assert "".join(t.edit for t in mine) == r.audit
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in mine if t.edit != "D").encode()).hexdigest() == r.repaired_sha256
        assert all((t.text is None) == (t.edit == "D") for t in mine)


def test_damage(spark):
    rows = [(c, t, "assistant", f"a {c}. b!") for c in range(40) for t in (0, 1, None)] + [(None, 3, None, None)]
    got = structure.damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        m = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want += {0: [(c, t, "user", "", True)], 1: [(c, t, role, "", False)], 2: [(c, t, role, re.sub("[.!?]", "", text), False)], 3: [(c, t, role, text, False)] * 2, 4: [(c, t, "user", text, False)]}.get(m, [(c, t, role, text, False)])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    lost = structure.report(structure.damaged(spark.createDataFrame([(c, 0, "user", "x") for c in range(200)], "conv_id bigint, turn bigint, role string, text string"))).collect()
    none = [tuple(r)[1:] for r in lost if zlib.crc32(f"{r.conv_id}:0".encode()) % 20 == 0]
    assert len(lost) == 200 and none and set(none) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_and_long(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string"
    assert structure.report(spark.createDataFrame([], kinds)).count() == 0 == structure.repaired(spark.createDataFrame([], kinds)).count()
    long = [(1, n, "user" if n % 2 == 0 else "assistant", f"{n}." * (50_000 if n == 7 else 1)) for n in range(20_000)]
    blank = [(2, 0, "user", "One.")] + [(2, n, "user", "") for n in range(1, 5_000)] + [(2, 5_000, "assistant", "Two.")]
    got = {r.conv_id: r for r in structure.report(spark.createDataFrame(long + blank, kinds)).collect()}
    assert (got[1].cost, got[1].audit) == (0, "K" * 20_000)
    assert (got[2].cost, got[2].audit) == (9_998, "K" + "D" * 4_999 + "K")


def test_held_texts_are_few():
    parse, held = structure.Parse(lambda *a: None), 0
    rng = random.Random(2)
    for n in range(3_000):
        parse.row(n, rng.choice(["user", "assistant", "system", "x"]), f"t{n}", rng.choice(["", "", "truncated", "blank"]))
        held = max(held, sum(t is not None for _, _, t in parse.rows))
    assert held < 100 and len(parse.end()["audit"]) >= 3_000
