"""Repaired conversations against a shortest-path search over whole conversations, and against all edits of short ones."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from churnkit.llm import repair as R
from churnkit.llm.queries import QUERIES

FORM = re.compile(r"(s?(ua)+)?\Z")


def all_edits(marks):
    """The least (cost, initials) by trying everything up to some inserts; checks the form itself."""
    best = None
    options = []
    for m in marks:
        more = 0 if m.islower() else 1
        own = [("D", 3, "")]
        if m != ".":
            own += [("R", 2 + more, "u"), ("R", 2 + more, "a")]
            if m.lower() in "sua":
                own.append(("K", more, m.lower()))
        options.append(own)
    for inserts in itertools.product((0, 1, 2), repeat=len(marks) + 1):
        if sum(inserts) > 3:
            continue
        for which in itertools.product("ua", repeat=sum(inserts)):
            for own in itertools.product(*options):
                audit, form, cost, k = "", "", 0, 0
                for i in range(len(marks) + 1):
                    for _ in range(inserts[i]):
                        audit, form, cost, k = audit + "I", form + which[k], cost + 2, k + 1
                    if i < len(marks):
                        audit, form, cost = audit + own[i][0], form + own[i][2], cost + own[i][1]
                if FORM.match(form) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def search(marks):
    """The same by a queue ordered by cost and initials."""
    queue, seen = [(0, "", 0, "", "")], set()
    while queue:
        cost, audit, at, state, _ = heapq.heappop(queue)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(marks) and state in ("", "a"):
            return cost, audit
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for c in nexts.replace("s", ""):
            heapq.heappush(queue, (cost + 2, audit + "I", at, c, ""))
        if at < len(marks):
            m = marks[at]
            more = 0 if m.islower() else 1
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state, ""))
            if m != ".":
                for c in nexts.replace("s", ""):
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, c, ""))
                if m.lower() in nexts and m.lower() in "sua":
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, m.lower(), ""))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def plain(rows, solve=search, damage=damaged):
    """One row per conversation by the rule as it is written."""
    by = {r[0]: [] for r in rows}
    for r in damage(rows):
        by[r[0]].append(r)
    result = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        counts, marks, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, _, role, text in own:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signs = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else None
            if fault:
                counts[fault] += 1
            marks += "." if fault in ("blank", "duplicate") else letter.upper() if fault else letter
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        cost, audit = solve(marks)
        left, at, form = [], 0, ""
        for e in audit:
            name = "assistant" if form[-1:] == "u" else "user"
            if e == "I":
                left.append((name, ""))
            elif e != "D":
                left.append((own[at][2] if e == "K" else name, own[at][3]))
            at += e != "I"
            form += left[-1][0][0] if e != "D" else ""
        assert FORM.match(form)
        result.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
                       sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                       hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(result, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
DDL = "conv_id long, turn long, role string, text string"


def run(spark, rows, parts=4, **options):
    got = R.damaged_and_repaired(spark.createDataFrame(rows, DDL).repartition(parts), **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=repr)


def test_search_is_exact():
    pick = random.Random(1)
    cases = ["", ".", "s", "u", "a", "su", "ua", "au", "sS", "uuaa"] + ["".join(pick.choice("suaoSUAO.") for _ in range(pick.randint(1, 3))) for _ in range(40)]
    for marks in cases:
        assert R.cheapest(marks, R.START, R.FINAL) == all_edits(marks) == search(marks), marks


def test_long_and_hard_ones():
    pick = random.Random(2)
    for n in (10, 64, 64, 64, 64, 64):
        for letters in ("suaoSUAO.", "sua", "aA.", "uU", "oO", "ua"):
            marks = "".join(pick.choice(letters) for _ in range(n))
            assert R.cheapest(marks, R.START, R.FINAL) == search(marks), marks


def test_parts_go_together():
    pick = random.Random(3)
    for _ in range(200):
        marks = "".join(pick.choice("suaoUA.") for _ in range(pick.randint(2, 30)))
        cut = [marks[i:i + 5] for i in range(0, len(marks), 5)]
        tables = [[{"entry": e, "exit": x, "cost": f[0], "audit": f[1]} for e in range(4) for x in range(4) if (f := R.cheapest(c, e, (x,)))] for c in cut]
        chosen = R.choose_ways(tables)
        ways = [next(w for w in t if (w["entry"], w["exit"]) == c) for t, c in zip(tables, chosen, strict=True)]
        assert (sum(w["cost"] for w in ways), "".join(w["audit"] for w in ways)) == search(marks)


@pytest.fixture(scope="module")
def talks():
    pick = random.Random(4)
    texts = ["Yes.", "No!", "cut off", "", " \t", "What? ", "é…", "end.\n"]
    rows = []
    for conv in [*range(120), None]:
        for k in range(pick.randint(1, 9)):
            turn = pick.choice([k, k, k, 2 * k, None])
            rows.append((conv, turn, pick.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]),
                         pick.choice([*texts, f"own {pick.random()}.", None])))
    return rows


def test_equals_plain_search(spark, talks):
    assert run(spark, talks) == plain(talks)


def test_long_conversations_in_parts(spark, talks):
    pick = random.Random(5)
    rows = talks + [(500, i, pick.choice(["user", "assistant"]), f"text {i % 400}" + pick.choice([".", ""])) for i in range(1500)]
    want = plain(rows)
    assert run(spark, rows, part_turns=7) == want
    assert run(spark, rows) == want


def test_a_turn_repeated_very_often(spark):
    rows = [(1, 5, "user", "again and again.")] * 900 + [(1, 6, "assistant", "Well.")] + [(k, 1, "user", "hello") for k in range(2, 300)]
    assert run(spark, rows) == plain(rows)


def test_parts_carry_the_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 1, "user", "Hi.", 7), (1, 2, "user", "Hi.", 7), (1, 3, "tool", "So.", 7), (2, 1, "assistant", "No", 7)],
                                 DDL.replace("conv_id", "c") + ", part int")
    got = {r.c: r for r in R.repair_conversations(rows, "c").collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "Hi."), ("assistant", "So.")] and got[1].audit == "KDR"
    assert [(t.role, t.text) for t in got[2].turns] == [] and got[2].audit == "D"


def test_empty_table(spark):
    assert run(spark, []) == []


def test_all_rows_lost(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    assert run(spark, [(lost, 1, "user", "x")]) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_the_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{d}/conversations.parquet").collect()]
    got = QUERIES["op13_conversation_repair"](spark, d)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == plain(rows)
