"""Conversation repair against searches that know nothing of trees or survivors."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from starmetrics.llm import conversations as cv
from tests.conftest import SF_SMALL

PATTERN = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")
STATE = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = BLANK.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Dijkstra over (row, state) with the whole string in the key."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, s, i, q, kept = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, s, kept
        for c, n in STATE[q].items():
            if c != "s":
                heapq.heappush(heap, (cost + 3, s + "I", i, n, (*kept, ({"u": "user", "a": "assistant"}[c], ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, s + "D", i + 1, q, kept))
            if fault[i] in ("blank", "duplicate"):
                continue
            more = 3 if fault[i] == "truncated" else 0
            for c, n in STATE[q].items():
                if role[:1] == c:
                    heapq.heappush(heap, (cost + more, s + "K", i + 1, n, (*kept, (role, text))))
                if c != "s":
                    heapq.heappush(heap, (cost + 3 + more, s + "R", i + 1, n, (*kept, ({"u": "user", "a": "assistant"}[c], text))))
    raise AssertionError


def every_edit(rows, fault):
    """All edit strings with up to three insertions in a gap."""
    best = None
    for choice in itertools.product(*[[(w, k) for w in (["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"]) for k in itertools.product("ua", repeat=0)] for f in fault]):
        for gaps in itertools.product([g for n in range(4) for g in itertools.product("ua", repeat=n)], repeat=len(rows) + 1):
            initials, s, cost = "", "", 0
            for i in range(len(rows) + 1):
                for c in gaps[i]:
                    initials, s, cost = initials + c, s + "I", cost + 3
                if i < len(rows):
                    w = choice[i][0]
                    s += w[0]
                    cost += {"D": 4, "K": 0, "R": 3}[w[0]] + (3 if fault[i] == "truncated" and w != "D" else 0)
                    initials += "" if w == "D" else w[1] if w[0] == "R" else rows[i][1][:1] or "?"
            if PATTERN.fullmatch(initials) and (best is None or (cost, s) < best):
                best = (cost, s)
    return best


def want(rows):
    """conv_id → the columns of the query."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = damaged([r for r in rows if r[0] == conv])
        f = faults(after)
        cost, audit, kept = cheapest(after, f)
        turns = [t for t, _, _ in after if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                     illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def same(spark, df, rows):
    got = {r["conv_id"]: tuple(r)[1:] for r in cv.digest(cv.judged(cv.damage(df))).collect()}
    assert got == want(rows)


ROLES = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
TEXTS = ["Yes.", "No", "", " \n", "a!", "b?", "same text.", None, "é…", "x. \t"]


def random_rows(seed, convs=60, most=14, roles=ROLES):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rng.randrange(1, most)):
            rows.append((c, rng.choice([None, t, t, t, t + 2, -t]), rng.choice(roles), rng.choice(TEXTS) if rng.random() < 0.5 else f"Text {rng.random()}."))
    return rows


@pytest.mark.parametrize("seed,roles", [(1, ROLES), (2, ["user"]), (3, ["user", "assistant"]), (4, ["system", "assistant"])])
def test_random_conversations(spark, seed, roles):
    rows = random_rows(seed, roles=roles)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' fault", "'y' dropped", "1 kind", "2 _seen", "3 step")
    same(spark, df.repartition(5), rows)


def test_search_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "a.", "c."])) for i in range(rng.randrange(0, 3))]
        f = faults(rows)
        assert cheapest(rows, f)[:2] == every_edit(rows, f)


def test_survivors_without_spark():
    """Long runs with ties, and how little stays open."""
    rng = random.Random(7)
    for roles in (["user"], ["assistant"], ["user", "assistant"], ["system", "user", "assistant", "tool"]):
        rows = [(i, rng.choice(roles), f"t{i}." if rng.random() < 0.9 else "cut") for i in range(300)]
        f, work, audit = faults(rows), cv.Repair(), []
        for (turn, role, text), fault in zip(rows, f):
            audit += work.step(turn, role, text, fault in ("blank", "duplicate"), fault == "truncated")
        cost, rest = work.end()
        audit += rest
        c, s, kept = cheapest(rows, f)
        assert (cost, "".join(e for e, *_ in audit), tuple((r, t) for e, r, t, _ in audit if e != "D")) == (c, s, kept)
    work, most = cv.Repair(), 0
    for i in range(20_000):
        work.step(i, "user" if i % 2 == 0 else "assistant", f"t{i}.", False, False)
        most = max(most, work.open)
    assert most < 50  # ordinary turns coalesce at once


def test_table_and_edits(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    same(spark, df, rows)
    expect, edits = want(rows), {}
    for r in sorted(cv.repair(cv.judged(cv.damage(df))).collect(), key=lambda r: (r["conv_id"], r["step"])):
        edits.setdefault(r["conv_id"], []).append(r)
    for conv, w in expect.items():
        own = edits.get(conv, [])
        assert "".join(r["edit"] for r in own) == w[6]
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own if r["edit"] != "D").encode()).hexdigest() == w[7]


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert cv.digest(cv.judged(cv.damage(empty))).count() == 0 and cv.repair(cv.judged(cv.damage(empty))).count() == 0
    gone = next((c, t) for c in range(1000) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(*gone, "user", "Hi."), (7_000, 1, "user", "word " * 300_000 + "."), (7_000, 2, "assistant", "same."), (7_000, 3, "assistant", "same.")]
    rows += [(8_000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(3_000)]
    df = spark.createDataFrame(rows, schema)
    same(spark, df, rows)
    got = {r["conv_id"]: r for r in cv.digest(cv.judged(cv.damage(df))).collect()}[gone[0]]
    assert tuple(got)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_sql_on_odd_rows():
    """The oracle's SQL against the search, on nulls, ties and odd roles."""
    import duckdb
    import pyarrow as pa
    rows = random_rows(11, convs=40)
    con = duckdb.connect()
    con.register("conversations", pa.table({n: pa.array(c, t) for n, c, t in zip(("conv_id", "turn", "role", "text"), zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))}))
    assert {r[0]: r[1:] for r in con.execute(cv.sql()).fetchall()} == want(rows)
