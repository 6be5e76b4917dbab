"""Conversation repair against an exhaustive search of edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tablecheck.llm import conversation_repair as repair

GRAMMAR = re.compile(r"(s?(ua)+)?$")
COLUMNS = "conv_id long, turn long, role string, text string"


def order(rows):
    def place(row):
        digest = hashlib.md5(row[2].encode()).digest()
        return row[0] is not None, row[0] or 0, row[1], digest

    return sorted(rows, key=place)


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        if not core:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def edits_of(row, fault):
    yield 2, "D", None
    if fault in ("blank", "duplicate"):
        return
    extra = 5 if fault else 0
    yield extra, "K", (row[1], row[2])
    for role in ("user", "assistant"):
        yield 1 + extra, "R", (role, row[2])


def exhaustive(rows, found):
    """Every edit of every row and up to two inserts at every place."""
    inserts = [((), "")]
    for size in (1, 2):
        for roles in itertools.product(("user", "assistant"), repeat=size):
            inserts.append((tuple((r, "") for r in roles), "I" * size))
    best = None
    for chosen in itertools.product(*[list(edits_of(r, f)) for r, f in zip(rows, found)]):
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c[0] for c in chosen) + 5 * sum(len(p[0]) for p in places)
            if best and cost > best[0]:
                continue
            out, audit = list(places[0][0]), places[0][1]
            for (_, edit, row), (extra, letters) in zip(chosen, places[1:]):
                out += ([row] if row else []) + list(extra)
                audit += edit + letters
            if GRAMMAR.match("".join(role[:1] or "?" for role, _ in out)):
                candidate = cost, audit, out
                if best is None or candidate[:2] < best[:2]:
                    best = candidate
    return best


def expected(rows, search):
    rows = order(rows)
    found = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, out = search(rows, found)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (
        gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest,
    )


def forward(rows, found):
    """Programme row by row with whole texts, for long conversations."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = {"": (0, "", ())}

    def take(into, state, cost, audit, out):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = cost, audit, out

    def inserted(states):
        for _ in range(3):
            more = dict(states)
            for state, (cost, audit, out) in states.items():
                for role in ("user", "assistant"):
                    if (state, role[0]) in steps:
                        take(more, role[0], cost + 5, audit + "I", (*out, (role, "")))
            states = more
        return states

    for row, fault in zip(rows, found):
        after = {}
        for state, (cost, audit, out) in inserted(states).items():
            for price, edit, changed in edits_of(row, fault):
                if changed is None:
                    take(after, state, cost + price, audit + edit, out)
                elif (state, changed[0][:1]) in steps:
                    into = steps[state, changed[0][:1]]
                    take(after, into, cost + price, audit + edit, (*out, changed))
        states = after
    ends = inserted(states)
    return min(ends[s] for s in ("", "a") if s in ends)


def solved(spark, rows):
    frame = spark.createDataFrame(rows, COLUMNS)
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame).collect()}


def some_rows(random, size):
    texts = ["Yes.", "No!", "cut", "", " \t", "Why?", "Long text."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", ""]
    return [(random.randrange(6), random.choice(roles), random.choice(texts)) for _ in range(size)]


def test_short_conversations_like_an_exhaustive_search(spark):
    draw = random.Random(3)
    given = {k: some_rows(draw, k % 4 + 1) for k in range(60)}
    rows = [(k, *row) for k, of in given.items() for row in of]
    assert solved(spark, rows) == {k: expected(of, exhaustive) for k, of in given.items()}


@pytest.mark.parametrize("piece", [3, 4096])
def test_long_conversations_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    monkeypatch.setattr(repair, "BLOCK", 40)
    draw = random.Random(5)
    given = {k: [(t, *row[1:]) for t, row in enumerate(some_rows(draw, 30))] for k in range(12)}
    # texts of its own, so that not nearly all are duplicates
    given[3] = [(t, r, f"{t}{x}" if x.strip() else x) for t, r, x in given[3] * 20]
    given[None] = [(t, r, f"{t}{x}") for t, r, x in given[5] * 9]
    rows = [(k, *row) for k, of in given.items() for row in of]
    assert solved(spark, rows) == {k: expected(of, forward) for k, of in given.items()}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "Hello."),
        (1, None, "user", "Hello."),
        (1, 3, "assistant", "b."),
        (1, 3, "assistant", "a."),
        (1, 3, "assistant", "a."),
        (2, None, "user", "x" * 300_000 + "."),
        (2, None, "user", None),
        (3, 4, "system", "Only."),
    ]
    frame = spark.createDataFrame(rows, COLUMNS)
    for name in ("conv", "audit", "digest", "fault", "own", "part"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    got = {r[0]: tuple(r)[1:] for r in repair.repair(frame).collect()}
    filled = {}
    for conv, turn, role, text in rows:
        row = (turn, " " if role is None else role, " " if text is None else text)
        filled.setdefault(conv, []).append(row)
    assert got == {k: expected(of, exhaustive) for k, of in filled.items()}
    assert repair.repair(frame.limit(0)).count() == 0


def test_conversations_without_rows_have_a_result(spark):
    all_rows = spark.createDataFrame([(k, 0, "user", "Hi.") for k in (1, 2, None)], COLUMNS)
    found = repair.repair_all(all_rows, all_rows.where("conv_id = 1")).collect()
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {r[0]: tuple(r)[1:] for r in found if r[0] != 1} == {2: empty, None: empty}
    assert len(found) == 3


def test_grammar_gives_the_sequences_back():
    draw = np.random.default_rng(1)
    given = [draw.integers(0, 3, size) for size in (0, 1, 2, 500, 40, 40)]
    given.append(np.zeros(101, np.int64))
    shrunk, rules = repair.re_pair(given, 3)
    assert rules and sum(map(len, shrunk)) < sum(map(len, given)) / 2

    def whole(symbol):
        return [symbol] if symbol < 3 else [x for s in rules[symbol - 3] for x in whole(s)]

    for before, after in zip(given, shrunk):
        assert [x for s in after.tolist() for x in whole(s)] == before.tolist()
