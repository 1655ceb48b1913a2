"""Conversation repair against a plain search over whole conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}  # state is the last initial
NAMES = {"u": "user", "a": "assistant"}


def allowed(state, initial):
    return initial == "s" and state == "" or initial == "u" and state in ("", "s", "a") or initial == "a" and state == "u"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        pick = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if pick == 1:
            text = ""
        if pick == 2:
            text = re.sub(r"[.!?]", "", text)
        if pick == 4:
            role = "user"
        if pick:
            out += [(conv, turn, role, text)] * (2 if pick == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1], r[2], r[3]))


def repaired(rows):
    """(cost, audit, rows) of the cheapest and then least edits, forward over all states."""
    best = {"": (0, "", ())}

    def offer(to, state, value):
        if state not in to or value < to[state]:
            to[state] = value

    def inserts(states):
        for _ in range(3):
            for s, (c, a, r) in list(states.items()):
                offer(states, NEXT[s], (c + 3, a + "I", (*r, NAMES[NEXT[s]] + ":")))

    for role, text, fault in rows:
        inserts(best)
        after = {}
        for s, (c, a, r) in best.items():
            offer(after, s, (c + 4, a + "D", r))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if allowed(s, role[:1]):
                    offer(after, role[:1], (c + extra, a + "K", (*r, f"{role}:{text}")))
                offer(after, NEXT[s], (c + 3 + extra, a + "R", (*r, f"{NAMES[NEXT[s]]}:{text}")))
        best = after
    inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = damage([r for r in rows if r[0] == conv])
        seen, faults, labelled = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, role, text in mine:
            end = text.rstrip(" \t\n\v\f\r")[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            labelled.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, kept = repaired(labelled)
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def run(spark, rows, parts=None, chunk=2048):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("mine") for c in ("pick", "gone", "at", "conv", "codes", "cost", "audit", "_copy", "_own")})
    if parts:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return sorted((tuple(r) for r in cv.repair(df, chunk).collect()), key=lambda r: (r[0] is not None, r[0]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def talk(rng, conv, n, roles=("user", "assistant")):
    rows = []
    for t in range(n):
        role = "system" if t == 0 and rng.random() < 0.3 else roles[t % 2] if rng.random() < 0.85 else rng.choice(["user", "assistant", "system", "tool", "", None])
        text = rng.choice(["Yes.", "No!", "Why?", "so it", " ", "", None, f"word {rng.randrange(30)}.", "a\nb. ", "é…"])
        rows.append((conv, rng.choice([t, t, t, None, t + 100]) if rng.random() < 0.1 else t, role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 50, 2048])
def test_chunks_of_any_length(spark, chunk):
    rng = random.Random(chunk)
    rows = [r for c in range(60) for r in talk(rng, c, rng.randint(1, 9))]
    rows += talk(rng, 1000, 300)  # one conversation over many chunks
    rows += [(2000, t, "user", "Same.") for t in range(150)]  # rows that hand every vector on
    rows += [(2001, None, "assistant", "Tie.")] * 40
    rows += [(None, t, r, x) for t, r, x in ((1, "user", "Hi."), (2, "assistant", "Ho."), (None, "user", "What"), (9, None, None))]
    rows += [(c, -5, "user", "x" * 50_000 + ".") for c in (-3, 60)]
    assert run(spark, rows, 5 if chunk > 1 else None, chunk) == brute(rows)


def test_everything_dropped_and_no_rows(spark):
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = run(spark, [(*gone, "user", "Hi.")])
    assert got == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert run(spark, []) == []


def test_turns_far_apart(spark):
    ends = [t for t in range(30) if zlib.crc32(f"5:{t - 2**62}".encode()) % 20 not in (0, 3)][:1]
    rows = [(5, ends[0] - 2**62, "user", "A."), (5, 2**62 + 1, "assistant", "B.")]
    assert run(spark, rows)[0][1] == min(brute(rows)[0][1], 2**63 - 1)


def test_reruns_stop_at_a_constant_difference():
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 40):
        for _ in range(30):
            codes = rng.integers(0, 4, n) + 4 * rng.integers(0, 3, n)
            old, new = rng.integers(0, 9, 4), rng.integers(0, 9, 4)
            close = lambda v: np.minimum(np.minimum(v, v[cv.NEXT] + 3), v[cv.NEXT][cv.NEXT] + 6)
            old, new = close(old), close(new)
            begin = cv.Chunks([codes]).to_go(old[None])[0, 0]
            want = cv.Chunks([codes]).to_go(new[None])[0, 0]
            assert (cv.rerun(codes, old, new, begin - begin.min()) == want - want.min()).all()
