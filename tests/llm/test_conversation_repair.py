"""Conversation repair against plain dynamic programming over whole audits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwright.llm import conversation_repair as C

SPACES = "\x20\t\n\x0b\x0c\r"


def damaged(rows):
    """conv -> rows (turn, role, text), as the contract says it."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0)) for c, own in out.items()}


def brute(rows):
    """Report of one conversation by comparing whole (cost, audit) pairs."""
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.strip(SPACES)
        faults.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}  # what came last -> what may follow
    best = [{} for _ in range(len(rows) + 1)]
    best[-1] = {"": (0, "", ()), "a": (0, "", ())}
    for i in range(len(rows), -1, -1):
        here = best[i]
        if i < len(rows):
            _, role, text = rows[i]
            for last in follow:
                options = []

                def add(edit, cost, line, state):
                    if state in best[i + 1]:
                        c, a, lines = best[i + 1][state]
                        options.append((c + cost, edit + a, ((line,) if line else ()) + lines))

                add("D", 3, None, last)
                if faults[i] not in ("b", "d"):
                    more = 1 if faults[i] else 0
                    if role == "":
                        add("K", more, f":{text}", last)
                    elif role[0] == follow[last] or (role[0] == "s" and last == ""):
                        add("K", more, f"{role}:{text}", role[0])
                    name = "user" if follow[last] == "u" else "assistant"
                    add("R", 2 + more, f"{name}:{text}", name[0])
                if options:
                    here[last] = min(options)
        for _ in range(4):  # insertions, any number
            for last, to in follow.items():
                if to in here:
                    c, a, lines = here[to]
                    option = (c + 2, "I" + a, (("user:" if to == "u" else "assistant:"),) + lines)
                    here[last] = min(here.get(last, option), option)
    cost, audit, lines = best[0][""]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(rows, rows[1:], strict=False)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] or not b[1] for a, b in pairs)
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def reports(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def expected(groups):
    return sorted(((c, *brute(rows)) for c, rows in groups.items()), key=str)


def conversation(rng, conv, n, roles=("user", "assistant")):
    texts = ["Yes.", "No", "What now?", "", " \n", "Fine!", "A long answer.\nWith a second line", None]
    out, turn = [], 0
    for k in range(n):
        role = roles[k % len(roles)] if rng.random() < 0.8 else rng.choice(["system", "user", "assistant", "tool", "", None, "usher"])
        text = rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}{rng.choice(['.', '!', ''])}"
        out.append((conv, None if turn == 0 and rng.random() < 0.1 else turn, role, text))
        turn += rng.choice([1, 1, 1, 2, 5])
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.repartition(5).selectExpr("*", "1 as uid", "'x' as key", "true as done", "0 as code", "'y' as lines", "2 as cid", "3 as tie")


def check(spark, rows):
    report, messages = C.repair(spark, C.damage(frame(spark, rows)))
    want = expected(damaged(rows))
    assert reports(report) == want
    lines = {}
    for m in sorted(messages.collect(), key=lambda m: (m.uid, m.nth)):
        lines.setdefault(m.conv_id, []).append(f"{m.role}:{m.text}")
    got = {c: hashlib.sha256("\n".join(own).encode()).hexdigest() for c, own in lines.items()}
    assert all(got.get(r[0], hashlib.sha256(b"").hexdigest()) == r[-1] for r in want)


def test_many_small_conversations(spark):
    rng = random.Random(4)
    rows = [r for conv in range(300) for r in conversation(rng, conv, rng.randint(1, 9))]
    rows += [(None, t, "user", f"null conversation {t}.") for t in range(4)] + [(900, None, None, None), (901, 1, "", "."), (902, -5, "system", "Go.")]
    rows += [(903, t, "system", "Only systems.") for t in range(3)] + [(904, 0, "assistant", "x."), (905, 0, "user", "x.")]
    # A conversation whose only row is dropped.
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, rows + [(gone, 0, "user", "Hi.")])


@pytest.mark.parametrize("passes", [C.PASSES, 0])
def test_long_conversations(spark, monkeypatch, passes):
    monkeypatch.setattr(C, "PASSES", passes)
    rng = random.Random(5)
    rows = conversation(rng, 1, 2500) + [r for conv in range(2, 30) for r in conversation(rng, conv, 5)]
    rows += [(50, t, "user", "Always the same.") for t in range(2300)]
    rows += [(51, t, "tool", f"Unknown {t}.") for t in range(2301)] + [(52, t, "", f"Empty role {t}.") for t in range(1500)]
    rows += [(None, t, "assistant", f"{t}.") for t in range(1300)]
    check(spark, rows)


def test_repeated_rows_of_one_turn(spark):
    rows = [(1, 3, "user", "Same turn, same text.")] * 1500 + [(1, t, ("user", "assistant")[t % 2], f"{t}!") for t in range(40)]
    rows += [(2, None, "user", "No turn.")] * 30
    rows = [r for r in rows if zlib.crc32(f"{r[0]}:{' ' if r[1] is None else r[1]}".encode()) % 20]
    report, _ = C.repair(spark, C.damage(frame(spark, rows)))
    got = {r.conv_id: r for r in report.collect()}
    groups = damaged(rows)
    assert {c: got[c].duplicate for c in got} == {c: brute(own)[2] for c, own in groups.items()}
    assert got[1].audit == brute(groups[1])[6] and got[1].cost == brute(groups[1])[5]


def test_given_tables_and_edges(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert reports(C.repair(spark, C.damage(table))[0]) == expected(damaged(rows))
    assert C.repair(spark, table.where("1 = 0"))[0].count() == 0
    plain = C.repair(spark, table.where(F.col("conv_id") == rows[0][0]))[0].first()
    assert plain.conv_id == rows[0][0]


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    rng = random.Random(6)
    codes = [C.code_of(rng.choice(["user", "assistant"]), rng.choice(["", "", "truncated"])) for _ in range(500)]
    guess, true = C.sweep(codes, C.GUESS), C.sweep(codes, C.END)
    assert C.sweep(codes, C.END, guess) == true
    assert guess[:400] == true[:400]
