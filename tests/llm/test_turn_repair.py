"""Repaired conversations against plain counting over all edits."""

import random
import re
from collections import Counter

import pytest

from webcorpus.llm import turn_auction as auction

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, cell bigint"
EDITS = "DIKR"


def step(state, letter, initial):
    """The state after an edit, None where it isn't allowed."""
    if letter == "D":
        return state
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
    if letter in "IR":
        return wanted
    return initial if initial == wanted or (state == "" and initial == "s") else None


def plain(rows):
    """Least (cost, letters) with the rows they give, row by row over all states."""
    def insert(ways):
        for _ in range(2):
            for state, (cost, letters, out) in list(ways.items()):
                to = step(state, "I", None)
                made = (cost + 3, letters + "I", out + [("user" if to == "u" else "assistant", "")])
                if to not in ways or made[:2] < ways[to][:2]:
                    ways[to] = made
        return ways

    seen, faults, ways = set(), Counter(), insert({"": (0, "", [])})
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        ahead = {}
        for state, (cost, letters, out) in ways.items():
            for letter in EDITS:
                if letter == "I" or (fault in ("blank", "duplicate") and letter != "D"):
                    continue
                to = step(state, letter, role[:1])
                if to is None:
                    continue
                price = {"D": 4, "K": 0, "R": 3}[letter] + (3 if fault == "truncated" and letter != "D" else 0)
                kept = [] if letter == "D" else [(role if letter == "K" else {"u": "user", "a": "assistant"}[to], text)]
                made = (cost + price, letters + letter, out + kept)
                if to not in ahead or made[:2] < ahead[to][:2]:
                    ahead[to] = made
        ways = insert(ahead)
    cost, letters, out = min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, out


def corpus():
    draw = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 14)):
            if draw.random() < 0.1:
                continue
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["a.", "b", "c!", "", " \t", "long " * 20 + "?", "d. \n", "é.", "é", None]) if draw.random() < 0.6 else f"text {conv} {turn}."
            rows.append((conv, turn if draw.random() < 0.9 else None, role, text, "clash", turn))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "assistant", "alone.", None, None), (None, 2, None, None, None, None)]
    for turn in range(700):  # one long conversation
        role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool"])
        rows.append((900, turn, role, draw.choice(["yes.", "no"]) if draw.random() < 0.3 else f"{turn}" + draw.choice([".", "!", ""]), "x", 0))
    rows.append((901, 0, "user", "word " * 200_000 + ".", "x", 0))
    return rows


@pytest.mark.parametrize("cell", [12, 4, 0])
def test_conversations(spark, monkeypatch, cell):
    """Also where every conversation is cut into parts of a few rows, or of one."""
    monkeypatch.setattr(auction, "CELL", cell)
    rows = corpus()
    audits, repaired = auction.repair_conversations(spark.createDataFrame(rows, SCHEMA))
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: r.line):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    found = {r.conv_id: r for r in audits.collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        own = [(turn, role if role is not None else " ", text if text is not None else " ") for c, turn, role, text, *_ in rows if c == conv]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        blank, duplicate, truncated, illegal, cost, letters, out = plain([(role, text) for _, role, text in own])
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (
            gaps, blank, duplicate, truncated, illegal, cost, letters
        ), conv
        assert lines.get(conv, []) == out
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))


def test_ties_take_the_first_letters():
    for codes, want in ((bytes([1, 1]), None), (bytes([2]), None), (bytes([3, 3]), None), (bytes([1, 1, 2, 2]), None), (b"", (0, ""))):
        roles = [{0: "system", 1: "user", 2: "assistant", 3: "tool"}[c] for c in codes]
        cost, letters = plain([(role, f"{i}.") for i, role in enumerate(roles)])[4:6]
        assert auction.solve(codes) == (want or (cost, letters))


def test_prices_are_exact_costs():
    """At every node, not only on the path; steps grow with the rows, not with their square."""
    draw = random.Random(2)
    steps = {}
    for rows in (200, 400, 800):
        codes = bytes(draw.choice([0, 1, 2, 3, 4, 9, 10]) for _ in range(rows))
        arcs, calls = auction.lattice(codes, auction.ENDS, True), [0]

        def counted(node, arcs=arcs, calls=calls):
            calls[0] += 1
            return arcs(node)

        nodes = auction.STATES * (rows + 1)
        price = auction.converge(nodes, counted)
        assert all(price[n] == min(cost + price[to] for _, cost, to in arcs(n)) for n in range(nodes))
        steps[rows] = calls[0]
    assert steps[800] < 5 * steps[200]


def test_empty(spark):
    audits, repaired = auction.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert audits.collect() == [] and repaired.collect() == []
