"""Cheapest repair of conversations to the form (s?(ua)+)?, by depth-first branch and bound.

Turns are put in order by ranges of (conversation, turn), so a long conversation is dealt over many tasks. A task solves parts of
bounded length. A conversation within one part is done then; one that goes over several gets for each part the best repair
from each state of the form to each other, and a pass over these small tables chooses how the parts go together.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import stored

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
# Turns of one part: bounds the search and a row of its results.
PART_TURNS = 64
# States of the form by the last initial written: nothing yet, s, u, a.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}
_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")


def _wanted(state: int) -> str:
    """The initial that a rewritten or added turn takes in a state."""
    return "a" if state == USER else "u"


def suffix_bounds(turns: str, exits: tuple[int, ...]) -> list[list[float]]:
    """For each place and state a lower bound of what leads from there to one of ``exits``, found from the end: by costs alone,
    whatever initials they give.

    A turn is written as its initial (s, u, a, or o for another one), in upper case if truncated, or as . if it has to go.
    """
    none = float("inf")
    now = [0 if state in exits else none for state in range(4)]
    out = []
    for turn in [None, *reversed(turns)]:
        if turn is not None:
            more, after = turn.isupper(), now
            now = [DELETE + c for c in after]
            if turn != ".":
                for state in range(4):
                    kept = _NEXT.get((state, turn.lower()))
                    now[state] = min(now[state], REROLE + more + after[_NEXT[state, _wanted(state)]],
                                     none if kept is None else KEEP + more + after[kept])
        # inserted turns: two in a row lead back to where one is
        now[USER] = min(now[USER], INSERT + now[ASSISTANT])
        now = [min(c, INSERT + now[USER]) if state != USER else c for state, c in enumerate(now)]
        out.append(now)
    return out[::-1]


@lru_cache(maxsize=200_000)
def cheapest(turns: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """The least cost of leading ``turns`` from a state to one of ``exits``, and of the edits that cost so much the ASCII-least
    initials (Delete, Insert, Keep, Rerole); None if no edits lead there.

    Depth first with a stack of its own. A prefix is left if its cost and the bound of what follows exceed the incumbent's cost
    (or equal it with greater initials), or if its node, a place and a state, was reached by a better one. Prefixes of
    one node and cost have as many initials that are no Insert, so none begins another, and comparing them is enough.
    """
    bounds, n = suffix_bounds(turns, exits), len(turns)
    if bounds[0][entry] == float("inf"):
        return None
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + bounds[at][state]
            if least > best[0] or least == best[0] and audit > best[1][:len(audit)]:
                continue
        old = reached.get((at, state))
        if old is not None and old <= (cost, audit):
            continue
        reached[at, state] = cost, audit
        if at == n and state in exits and (best is None or (cost, audit) < best):
            best = cost, audit
        wanted = _wanted(state)
        moves = [(cost + INSERT, at, _NEXT[state, wanted], audit + "I")]
        if at < n:
            turn = turns[at]
            moves.append((cost + DELETE, at + 1, state, audit + "D"))
            if turn != ".":
                more = 0 if turn.islower() else 1
                moves.append((cost + REROLE + more, at + 1, _NEXT[state, wanted], audit + "R"))
                kept = _NEXT.get((state, turn.lower()))
                if kept is not None:
                    moves.append((cost + KEEP + more, at + 1, kept, audit + "K"))
        # the likeliest is taken first: the least cost with its bound, of equal ones the ASCII-least initial
        moves = [(m[0] + bounds[m[1]][m[2]], m[3][-1], m) for m in moves]
        moves.sort(reverse=True)
        stack += [(at, state, cost, audit) for least, _, (cost, at, state, audit) in moves if least < float("inf")]
    return best


def apply_edits(audit: str, roles: list[str], texts: list[str | None], entry: int = START) -> list[dict]:
    """The turns that edits leave."""
    out, at, state = [], 0, entry
    for edit in audit:
        role = _NAMES[_wanted(state)]
        if edit == "I":
            out.append({"role": role, "text": ""})
        elif edit != "D":
            out.append({"role": roles[at] if edit == "K" else role, "text": texts[at]})
        at += edit != "I"
        if edit != "D":
            state = _NEXT[state, out[-1]["role"][0]]
    return out


class _Part:
    """Consecutive turns of one conversation."""

    def __init__(self, conv):
        self.conv, self.roles, self.texts, self.marks, self.turns = conv, [], [], [], []

    def add(self, turn, role: str, text: str | None, fault: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        mark = role[:1] if role[:1] in ("s", "u", "a") else "o"
        self.marks.append({"blank": ".", "duplicate": ",", "truncated": mark.upper()}.get(fault, mark))

    def row(self, number: int, whole: bool) -> dict:
        marks = "".join(self.marks)
        plain = marks.replace(",", ".")
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        out = {"conv": self.conv, "part": number, "whole": whole, "blank": marks.count("."), "duplicate": marks.count(","),
               "truncated": sum(m.isupper() for m in marks),
               "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)), "first": initials[0],
               "last": initials[-1], "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
               "n_turns": len(set(known)), "cost": None, "audit": None, "turns": None, "ways": None, "roles": None, "texts": None}
        if whole:
            out["cost"], out["audit"] = cheapest(plain, START, FINAL)
            out["turns"] = apply_edits(out["audit"], self.roles, self.texts)
        else:
            found = {(e, x): cheapest(plain, e, (x,)) for e in range(4) for x in range(4)}
            out["ways"] = [{"entry": e, "exit": x, "cost": f[0], "audit": f[1]} for (e, x), f in found.items() if f]
            out["roles"], out["texts"] = self.roles, self.texts
        return out


def _fault(text: str) -> str:
    bare = text.rstrip(_BLANKS)
    return "blank" if not bare else "" if bare[-1] in ".!?" else "truncated"


def _turn_rows(batches):
    """(conv, turn, role, text, fault) of each turn in order, from the rows of ``_ordered``."""
    key = None
    for b in batches:
        for conv, turn, role, mark, kind, n, text, blank in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if kind == 0:
                key = conv, turn, role, mark
                yield conv, turn, role, text, _fault(text)
            else:
                for _ in range(n - (key == (conv, turn, role, mark))):
                    yield conv, turn, role, None, "blank" if blank else "duplicate"


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Turns in order, dealt over ranges of the order. The first turn with a role and text has its text; later ones, which have to go,
    are counted rows without it. Both are aggregations merged map-side, so a turn repeated very often is moved once."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        said.alias("text"), F.md5(said.cast("binary")).alias("mark"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("n"))
    first = rows.groupBy("conv", "role", "mark").agg(
        F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn")).alias("turn"), F.first("text").alias("text"))
    empty = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    every = rows.select("conv", "turn", "role", "mark", "n", empty.alias("blank")).groupBy("conv", "turn", "role", "mark").agg(
        F.sum("n").alias("n"), F.bool_or("blank").alias("blank"))
    order = ["conv", "turn", "role", "mark"]
    both = first.select(*order, F.lit(0).alias("kind"), F.lit(1).cast("long").alias("n"), "text", F.lit(None).cast("boolean").alias("blank")).union(
        every.select(*order, F.lit(1).alias("kind"), "n", F.lit(None).cast("string").alias("text"), "blank"))
    return both.repartitionByRange(*order).sortWithinPartitions(*order, "kind")


def _fields(conv_kind: str) -> str:
    return (f"conv {conv_kind}, part long, whole boolean, blank long, duplicate long, truncated long, illegal long, first string, "
            "last string, first_turn long, last_turn long, n_turns long, cost long, audit string, turns array<struct<role:string,text:string>>, "
            "ways array<struct<entry:int,exit:int,cost:long,audit:string>>, roles array<string>, texts array<string>")


def _batches_of(rows, schema: pa.Schema, most: int = 512):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _solved(ordered: DataFrame, part_turns: int) -> DataFrame:
    """A row for each part: repaired if it is a whole conversation, else with its table of ways."""
    ddl = _fields(ordered.schema["conv"].dataType.simpleString())
    struct = ordered.sparkSession.createDataFrame([], ddl).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        def rows():
            number, part, edge, opened = TaskContext.get().partitionId() << 32, None, True, False
            for conv, *turn in _turn_rows(batches):
                if part is not None and (conv != part.conv or len(part.turns) == part_turns):
                    same = conv == part.conv
                    # the first conversation of a task may begin before it, the last one go on behind it
                    yield part.row(number, not (edge or opened or same))
                    number += 1
                    edge, opened = edge and same, same
                    part = None
                part = part or _Part(conv)
                part.add(*turn)
            if part is not None:
                yield part.row(number, False)

        yield from _batches_of(rows(), to_arrow_schema(struct))

    return ordered.mapInArrow(run, ddl)


def choose_ways(tables) -> list[tuple[int, int]]:
    """(entry, exit) of each part of a conversation so that all of it costs least, of equal costs with the ASCII-least initials.

    Of the initials so far only what is not common to all states is held, so each part is compared once.
    """
    live: dict[int, tuple[int, str]] = {START: (0, "")}
    back: list[dict[int, int]] = []
    for ways in tables:
        after: dict[int, tuple[int, str, int]] = {}
        for w in ways:
            if w["entry"] in live:
                cost, audit = live[w["entry"]]
                new = cost + w["cost"], audit + w["audit"], w["entry"]
                if w["exit"] not in after or new[:2] < after[w["exit"]][:2]:
                    after[w["exit"]] = new
        back.append({x: a[2] for x, a in after.items()})
        common = len(os.path.commonprefix([a[1] for a in after.values()]))
        live = {x: (a[0], a[1][common:]) for x, a in after.items()}
    state = min((x for x in FINAL if x in live), key=lambda x: live[x])
    out = []
    for came in reversed(back):
        out.append((came[state], state))
        state = came[state]
    return out[::-1]


def _by_conversation(batches, names: list[str]):
    """(conversation, iterator of its rows) for rows sorted by conversation, as they stream by."""
    from itertools import groupby
    rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names), strict=True))
    return groupby(rows, key=lambda r: r[0])


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         copies: str | None = None, part_turns: int = PART_TURNS) -> DataFrame:
    """Repaired conversations as parts, in the order of ``part``: conv, part, whole (the conversation has no other part), faults found
    (blank, duplicate, truncated, illegal), ends (first, last, first_turn, last_turn, n_turns), cost, audit, turns.

    Turns of a conversation are taken by ``turn``, nulls first; turns of one number by role, then by a digest of their text. A
    turn's first fault counts: blank (nothing but ASCII white space), duplicate (role and text seen earlier), truncated (last other sign
    not one of .!?). Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (a must for blank and duplicate ones), Insert an empty
    turn 2; a truncated turn that stays adds 1. The cheapest edits that give role initials ``(s?(ua)+)?`` are applied, of equal
    costs those with the ASCII-least initials. Null roles and texts are one space; a role with another initial, or none, is never kept.
    ``copies`` names a column that tells how often a row counts. A null conversation is one as well. No rows give none.

    A part has ``part_turns`` turns at most and comes from one range of the order, so no task holds a conversation.
    """
    ordered = _ordered(turns, conv, turn, role, text, copies)
    solved = stored(_solved(ordered, part_turns), "parts")
    kind = solved.schema["conv"].dataType.simpleString()

    def choose(batches):
        for _, rows in _by_conversation(batches, ["conv", "part", "ways"]):
            numbers = []
            found = choose_ways(numbers.append(r[1]) or r[2] for r in rows)
            for at in range(0, len(found), 4096):
                some = found[at:at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[at:at + 4096], pa.int64()), pa.array([e for e, _ in some], pa.int32()), pa.array([x for _, x in some], pa.int32())],
                    ["part", "entry", "exit"])

    opened = solved.where("NOT whole")
    chosen = stored(opened.select("conv", "part", "ways").repartition("conv").sortWithinPartitions("conv", "part")
                    .mapInArrow(choose, "part long, entry int, exit int"), "ways")
    ddl = f"conv {kind}, " + _fields(kind).split(", ", 1)[1].split(", ways ")[0]
    struct = solved.sparkSession.createDataFrame([], ddl).schema

    def repaired(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        def rows():
            for b in batches:
                for r in b.to_pylist():
                    way = next(w for w in r["ways"] if (w["entry"], w["exit"]) == (r["entry"], r["exit"]))
                    yield {**r, "cost": way["cost"], "audit": way["audit"], "turns": apply_edits(way["audit"], r["roles"], r["texts"], r["entry"])}

        schema = to_arrow_schema(struct)
        yield from _batches_of(({n: r[n] for n in schema.names} for r in rows()), schema)

    joined = opened.join(chosen, "part").mapInArrow(repaired, ddl)
    return solved.where("whole").drop("ways", "roles", "texts").unionByName(joined).withColumnRenamed("conv", conv)


_SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SUMMARY = f"{', '.join(f'{n} long' for n in _SUMS)}, audit string, repaired_sha256 string"


def summarise(parts: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``repair_conversations``: gaps between the turn numbers, sums of the faults and costs, edits,
    and the digest of the repaired turns as role:text, joined by line ends.

    Conversations of one part are summed up where they are. The others stream by in order: a digest needs its text in order,
    so their parts meet in one task, which holds one part and the edits at a time.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    whole = parts.where("whole").select(conv, gaps.alias("gaps"), *_SUMS[1:], "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    names = [conv, "first", "last", "first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns"]
    kind = parts.schema[conv].dataType
    struct = parts.sparkSession.createDataFrame([], f"{conv} {kind.simpleString()}, {_SUMMARY}").schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        def rows():
            for key, group in _by_conversation(batches, names):
                out, audits, sha = dict.fromkeys(_SUMS, 0), [], hashlib.sha256()
                begun, before, low, high, distinct = False, "", None, None, 0
                for _, first, last, first_turn, last_turn, n_turns, *counts, audit, turns in group:
                    for n, c in zip(("blank", "duplicate", "truncated", "illegal", "cost"), counts, strict=True):
                        out[n] += c
                    out["illegal"] += bool(audits) and before + first not in _LEGAL
                    before = last
                    if first_turn is not None:
                        distinct += n_turns - (first_turn == high)
                        low, high = first_turn if low is None else low, last_turn
                    audits.append(audit)
                    for t in turns:
                        sha.update((("\n" if begun else "") + f"{t['role']}:{t['text']}").encode("utf-8", "surrogatepass"))
                        begun = True
                out["gaps"] = 0 if low is None else high - low + 1 - distinct
                yield {conv: key, **out, "audit": "".join(audits), "repaired_sha256": sha.hexdigest()}

        yield from _batches_of(rows(), to_arrow_schema(struct))

    apart = parts.where("NOT whole").select(*names, "part").repartition(conv).sortWithinPartitions(conv, "part")
    return whole.unionByName(apart.mapInArrow(run, f"{conv} {kind.simpleString()}, {_SUMMARY}"))


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with known faults: by crc32 of ``conv:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 removes .!? from it,
    3 repeats it (column ``copies``), 4 makes its role user. Nulls are one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text_of(conv), F.lit(":"), text_of(turn)).cast("binary")) % 20
    said, who = text_of(text), text_of(role)
    return turns.select(F.col(conv).alias(conv), F.col(turn).alias(turn), who.alias("who"), said.alias("said"), draw.alias("draw")).where("draw <> 0").select(
        conv, turn, F.when(F.col("draw") == 4, "user").otherwise(F.col("who")).alias(role),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said")).alias(text),
        F.when(F.col("draw") == 3, 2).otherwise(1).alias("copies"))


def damaged_and_repaired(turns: DataFrame, conv: str = "conv_id", part_turns: int = PART_TURNS) -> DataFrame:
    """The summary of every conversation of ``turns`` after ``damage``; zeros, no edits and the digest of nothing for one that has lost
    all its rows. An empty table gives none."""
    found = summarise(repair_conversations(damage(turns, conv), conv, copies="copies", part_turns=part_turns), conv)
    named = found.withColumnRenamed(conv, "found")
    every = turns.select(conv).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(named, F.col(conv).eqNullSafe(F.col("found")), "left").select(
        conv, *[F.coalesce(n, F.lit(0)).alias(n) for n in _SUMS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
