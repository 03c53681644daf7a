"""Conversation repair against a plain walk over (row, state), and against all edits of short conversations."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tests.conftest import SF
from tidewater.llm import conversations as cv
from tidewater.llm.queries import QUERIES

FORM = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = text.strip(cv.BLANKS)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, marks):
    """Least (cost, audit, repaired) by search over (row, roles so far reduced to a state)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, [line for line in made]
        for role in ("user", "assistant"):
            if role[0] in follow[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, role[0], (*made, f"{role}:")))
        if at < len(rows):
            role, text = rows[at][2:]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, made))
            if marks[at] not in ("blank", "duplicate"):
                extra = 5 * (marks[at] == "truncated")
                if role[:1] and role[:1] in follow[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[:1], (*made, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in follow[state]:
                        heapq.heappush(heap, (cost + extra + 1, audit + "R", at + 1, new[0], (*made, f"{new}:{text}")))
    raise AssertionError


def plain(rows):
    convs = {}
    for row in rows:
        convs.setdefault(row[0], [])
    for row in damaged(rows):
        convs[row[0]].append(row)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marks = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, made = cheapest(own, marks)
        out.append((conv, gaps, *[marks.count(f) for f in cv.FAULTS[1:]], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string, fault int")
    return sorted(map(tuple, cv.report(table, *cv.repair(cv.damage(table))).collect()), key=repr)


def talk(seed, convs, most, spread=3):
    draw = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(draw.randrange(most)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usr"])
            text = draw.choice(["Yes.", "No!", "What?", "cut off", " \n", "", None, "Long text. " * 30, f"{draw.random()}."])
            rows.append((conv, draw.choice([turn, turn + spread, turn, None]), role, text))
    return rows


@pytest.mark.parametrize("bits", [1, 2, 16])
def test_awkward_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(cv, "BLOCK_BITS", bits)
    rows = talk(bits, 40, 14) + [(None, 1, "user", "Hi."), (None, None, None, None), (7, 1, "user", "Again."), (7, 1, "user", "Again.")]
    assert got(spark, [(*r, "x", 1) for r in rows]) == plain(rows)


def test_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cv, "BLOCK_BITS", 3)
    rows = [(1, t, role, text) for t, (_, _, role, text) in enumerate(talk(5, 90, 14))]
    rows += [(2, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(60)]
    assert len(rows) > 500
    assert got(spark, [(*r, None, None) for r in rows]) == plain(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("seed", range(3))
def test_parse_is_least_of_all_edits(seed):
    """Every edit of every row and every insertion, for conversations of up to three rows."""
    draw = random.Random(seed)
    for _ in range(6):
        rows = [(draw.choice("suax"), draw.choice(cv.FAULTS)) for _ in range(draw.randrange(4))]
        options = []
        for initial, fault in rows:
            extra = 5 * (fault == "truncated")
            keep = [] if fault in ("blank", "duplicate") else [(extra, "K", initial), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
            options.append([(2, "D", ""), *keep])
        inserts = ["".join(x) for n in range(3) for x in itertools.product("ua", repeat=n)]
        least = min(
            (sum(e[0] for e in edits) + 5 * sum(map(len, between)), "".join("I" * len(b) + (e[1] if e else "") for b, e in zip(between, [*edits, None])))
            for edits in itertools.product(*options)
            for between in itertools.product(inserts, repeat=len(rows) + 1)
            if FORM.fullmatch("".join(b + (e[2] if e else "") for b, e in zip(between, [*edits, None])))
        )
        cell = cv.parse([cv.single(i, f) for i, f in rows])
        assert min(cell[0, q] for q in cv.ENDS if (0, q) in cell) == least


def test_every_split_gives_the_same_cell():
    draw = random.Random(4)
    cells = [cv.single(draw.choice("suax"), draw.choice(cv.FAULTS)) for _ in range(9)]
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for span in range(2, 10):
        for i in range(10 - span):
            splits = [cv.combine(chart[i, k], chart[k, i + span]) for k in range(i + 1, i + span)]
            assert all(s == splits[0] for s in splits)
            chart[i, i + span] = splits[0]
    assert chart[0, 9] == cv.parse(cells)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_conversations"](spark, SF).collect()), key=repr) == plain(rows)
