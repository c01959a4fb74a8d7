"""Conversation repair against a search over all edits, shortest audits first compared as text."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from skyledger.llm import conversation_repair as R

GOOD = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\v\f\r"


def plain_repair(rows):
    """Cheapest edits of (role, text, fault) by uniform cost search; equal costs come in the order of their audits."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, letters, out = heapq.heappop(heap)
        if at == len(rows) and GOOD.match(letters):
            return cost, audit, out
        # what may follow depends on the last letter only
        if (at, letters[-1:]) in seen:
            continue
        seen.add((at, letters[-1:]))

        def go(price, letter, role, text, step):
            grown = letters + role[:1]
            if role and not any(GOOD.match(grown + rest) for rest in ("", "a", "ua")):
                return
            heapq.heappush(heap, (cost + price, audit + letter, at + step, grown, out + (((role, text),) if role else ())))

        for role in ("user", "assistant"):
            go(2, "I", role, "", 0)
        if at < len(rows):
            role, text, fault = rows[at]
            go(3, "D", "", "", 1)
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if role:
                    go(late, "K", role, text, 1)
                for new in ("user", "assistant"):
                    go(2 + late, "R", new, text, 1)


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(BLANK)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_plan(rows):
    """rows of one conversation: (turn, role, text) in order."""
    faults = plain_faults([(r, t) for _, r, t in rows])
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, out = plain_repair(faults)
    kinds = [f for _, _, f in faults]
    pairs = list(zip([r[:1] for _, r, _ in rows], [r[:1] for _, r, _ in rows][1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, out)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = [" " if x is None else x for x in (role, text)]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_query(rows):
    out = []
    damaged = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted([r[1:] for r in damaged if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        *counts, repaired = plain_plan(mine)
        out.append((conv, *counts, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()))
    return out


def conversation(rng, n):
    roles = ["user", "assistant", "system", "tool", "u", "auto", "System", ""]
    return [(rng.choice(roles[: rng.choice([2, 3, 8])]), rng.choice(["Yes.", "No!", "so", "", " \t", "Why?", f"n {rng.random()}.", f"m {rng.random()}"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_paths(seed):
    rng = random.Random(seed)
    many = [plain_faults(conversation(rng, rng.choice([1, 2, 3, 5, 9, 30]))) for _ in range(60)]
    place = {"s": 0, "u": 1, "a": 2}
    kind = {None: 0, "truncated": 4, "blank": 8, "duplicate": 8}
    symbols = [np.array([place.get(r[:1], 3) + kind[f] for r, _, f in rows]) for rows in many]
    audits, states, costs = R.least_paths(symbols, np.tile(R._END_COST, (len(many), 1)))
    for rows, audit, state, cost in zip(many, audits, states, costs):
        assert (cost[0], audit[0] + R._END_AUDIT[state[0]]) == plain_repair(rows)[:2]


def rows_of(rng, n_convs):
    rows = []
    for c in range(n_convs):
        at = rng.randint(0, 3)
        for role, text in conversation(rng, rng.choice([1, 1, 2, 4, 8])):
            rows.append((c, at, role or None if rng.random() < 0.5 else role, text or None if rng.random() < 0.5 else text))
            at += rng.choice([1, 1, 1, 2, 5])
    return rows + [(None, None, "user", "a."), (None, 4, "assistant", "b."), (900, None, "user", "q?"), (901, None, None, None), (902, 7, "user", "x" * 300_000)]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("block", [4096, 3])
def test_query(spark, tmp_path, monkeypatch, block):
    """Also with fragments so short that conversations of many of them arise."""
    monkeypatch.setattr(R, "BLOCK", block)
    rng = random.Random(block)
    rows = rows_of(rng, 120)
    rows += [(1000, i, role, text) for i, (role, text) in enumerate(conversation(rng, 150))]
    spark.createDataFrame([(*r, "old") for r in rows], SCHEMA + ", audit string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op11_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", *R.COUNTS, "audit", "repaired_sha256"]
    got, expected = sorted(map(tuple, got.collect()), key=str), sorted(plain_query(rows), key=str)
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert [g for g, e in zip(got, expected) if g != e] == [] == [e for g, e in zip(got, expected) if g != e]


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well then."), (2, 0, "system", "Be good."), (2, 1, "user", "Why?")]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = R.plan_repairs(df)
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in plan.collect()} == {1: (5, "KDR"), 2: (2, "KKI")}
    got = R.apply_repairs(df, plan).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, 0, "user", "Hi.", "keep"), (1, 1, 2, "assistant", "Well then.", "rerole"),
        (2, 0, 0, "system", "Be good.", "keep"), (2, 1, 1, "user", "Why?", "keep"), (2, 2, None, "assistant", "", "insert"),
    ]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert R.op11_conversation_repair(spark, str(tmp_path)).collect() == []
