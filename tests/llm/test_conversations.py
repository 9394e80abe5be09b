"""Conversation repair against a plain search over all edits, whole tables, cut conversations and odd rows."""
import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tessera.llm import conversations as C

from .conftest import SF

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, _conv string, rows int, cost string"


def damage(conv, turn, role, text):
    t = lambda v: " " if v is None else str(v)
    k = zlib.crc32(f"{t(conv)}:{t(turn)}".encode()) % 20
    role, text = t(role), t(text)
    if k == 0:
        return []
    if k == 1:
        text = ""
    if k == 2:
        text = re.sub("[.!?]", "", text)
    if k == 4:
        role = "user"
    return [(turn, role, text)] * (2 if k == 3 else 1)


def plain(rows):
    """The result of one conversation by search over (row, state) with whole strings."""
    rows = sorted((r for row in rows for r in damage(*row)), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        if not text.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif text.rstrip(SPACE)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    role_of = {"": "u", "s": "u", "u": "a", "a": "u"}
    after = {"": (0, "", []), "a": (0, "", [])}  # costs, audits and rows to the end, by the last role
    after["u"] = (2, "I", ["assistant:"])
    after["s"] = (4, "II", ["user:", "assistant:"])
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        extra = fault == "truncated"
        now = {}
        for s in ("", "s", "u", "a"):
            ways = [(3 + after[s][0], "D" + after[s][1], after[s][2])]
            if fault not in ("blank", "duplicate"):
                asked = role_of[s]
                full = {"u": "user", "a": "assistant"}[asked]
                ways.append((2 + extra + after[asked][0], "R" + after[asked][1], [f"{full}:{text}", *after[asked][2]]))
                if role[:1] == asked or s == "" and role[:1] == "s":
                    t = role[:1]
                    ways.append((extra + after[t][0], "K" + after[t][1], [f"{role}:{text}", *after[t][2]]))
            now[s] = min(ways, key=lambda w: w[:2])
        for _ in range(4):
            for s in now:
                t = role_of[s]
                now[s] = min(now[s], (2 + now[t][0], "I" + now[t][1], [{"u": "user:", "a": "assistant:"}[t], *now[t][2]]), key=lambda w: w[:2])
        after = now
    cost, audit, out = after[""]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    roles = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def check(found, rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[:4])
    got = {r[0]: tuple(r[1:]) for r in found.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {k: plain(v) for k, v in by.items()}


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    found = C.query(spark, SF)
    assert found.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    check(found.withColumnRenamed("conv_id", "conv"), rows)


@pytest.mark.parametrize("chunk", [4, 1000])
def test_cut_conversations(spark, chunk):
    """Two long conversations that hold most rows, in chunks of a few rows and over many tasks."""
    some = random.Random(chunk)
    texts = ["Yes.", "No!", "cut off", "", " \t", "A line\nmore.", "Why?"] + [f"text {k}." for k in range(40)]
    rows = [(conv, some.randrange(150), some.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ä"]), some.choice(texts))
            for conv in [7] * 300 + [9] * 200 + list(range(20, 40)) * 3]
    rows += [(8, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(100)] + [(3, 1, "user", "same.")] * 50
    found = C.repair(C.damaged(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)), chunk)
    check(found, rows)


def test_rank_convergence(spark):
    """Chunks reach the vectors of a single backward run, whatever they start from."""
    rows = [(1, k, some, f"text {k}.") for k, some in enumerate(random.Random(5).choices(["user", "assistant", "system"], k=400))]
    chunks = C.chunked(C._ordered(C.damaged(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA))), 8).persist()
    entries, passes = C.converged(chunks)
    parts = sorted(chunks.select("part", "seq", "symbols").collect())
    at = {(r.part, r.seq): (tuple(r.end), r.entry) for r in entries.collect()}
    vector = C.END
    for r in reversed(parts):
        if r.symbols:
            assert C._least(at[r.part, r.seq][0]) == C._least(vector)
            vector = C.backward(C._split(r.symbols), vector)
    state = 0
    for r in parts:
        if r.symbols:
            assert at[r.part, r.seq][1] == state
            state = C._exits(C._split(r.symbols), at[r.part, r.seq][0])[state]
    assert passes <= 6 < len(parts)
    chunks.unpersist()


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 2, "user", "Hi."), (None, None, "assistant", "Hm"), (1, None, "user", "a."), (1, None, "user", "a."),
            (2, 0, "system", "Only."), (3, 0, "user", "long " * 200_000 + "end."), (3, 1, "assistant", None), (4, 5, "user", "?"), (5, 0, "tool", "x."), (6, -3, "user", "b."), (6, 4, "user", "b.")]
    check(C.repair(C.damaged(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA))), rows)
    assert C.repair(C.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_dropped_conversation_stays(spark):
    conv = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    r = C.repair(C.damaged(spark.createDataFrame([(conv, 0, "user", "Gone.", "x", 1, "y")], SCHEMA))).collect()
    assert [(x.conv, x.cost, x.audit, x.repaired_sha256, x.gaps) for x in r] == [(conv, 0, "", hashlib.sha256(b"").hexdigest(), 0)]
