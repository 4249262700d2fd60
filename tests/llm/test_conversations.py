"""Conversation repair beside a search that tries all edits, cheapest and least letters first."""

import hashlib
import heapq
import random
import re
import zlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from trainflow.llm import catalog, conversations

SMALLEST = Path("/root/testdata/sf0.001")
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """Per row: blank, duplicate, truncated or nothing."""
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def searched(rows):
    """Cheapest cost, least letters, repaired turns: every edit at every place, two inserts in a row too."""
    found = faults(rows)
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, letters, i, roles = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            break
        if (i, roles, letters[-2:] == "II") in done:
            continue
        done.add((i, roles, letters[-2:] == "II"))
        nexts = [(3, "I", i, r) for r in "ua" if letters[-2:] != "II"]
        if i < len(rows):
            nexts.append((4, "D", i + 1, ""))
            if found[i] not in ("blank", "duplicate"):
                more = 3 * (found[i] == "truncated")
                nexts.append((more, "K", i + 1, rows[i][1][:1] or "?"))
                nexts += [(3 + more, "R", i + 1, r) for r in "ua"]
        for extra, letter, j, r in nexts:
            if re.fullmatch("s?(ua)*u?", roles + r):
                heapq.heappush(heap, (cost + extra, letters + letter, j, roles + r))
    turns, i, k = [], 0, 0
    for letter in letters:
        if letter == "I":
            turns.append((NAMES[roles[k]], ""))
        elif letter != "D":
            turns.append((rows[i][1] if letter == "K" else NAMES[roles[k]], rows[i][2]))
        k += letter != "D"
        i += letter != "I"
    return cost, letters, turns


def plain(rows):
    """A conversation's row of the query from its damaged rows (turn, role, text)."""
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    cost, letters, turns = searched(rows)
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        filled = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{filled[0]}:{filled[1]}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", filled[3]) if kind == 2 else filled[3]
            out += [(conv, turn, "user" if kind == 4 else filled[2], text)] * (2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    every = {}
    for conv, *turn in rows:
        every.setdefault(conv, []).append(tuple(turn))
    return every


def result(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, later int")
    found = conversations.digests(conversations.edits(df)).collect()
    assert len({r["conv"] for r in found}) == len(found)
    return {r["conv"]: (*r["report"], r["audit"], r["sha256"]) for r in found}


def test_every_short_conversation(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(700):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "uncle"])
            text = rng.choice([f"Well {turn}.", f"Well {turn}!", f"Cut {turn}", "Same.", "", " \t"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    assert result(spark, rows) == {c: plain(r) for c, r in by_conversation(rows).items()}


def test_long_ties(spark):
    """Long runs in which several repairs cost the same and no edit is settled for long."""
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        kinds = rng.choice([["user"], ["assistant"], ["user", "assistant"], ["system", "user"], ["tool"]])
        cut = rng.random() < 0.7
        first = [(conv, -1, "system", "Be kind.")] if rng.random() < 0.5 else []
        rows += first + [(conv, t, rng.choice(kinds), f"{t}{'' if cut else '.'}") for t in range(rng.randint(8, 14))]
    assert result(spark, rows) == {c: plain(r) for c, r in by_conversation(rows).items()}


def test_open_edits_stay_few():
    """A conversation far longer than what a task holds of it."""
    rng = random.Random(3)
    repair, most, settled = conversations.Repair(), 0, 0

    def size(edit):
        return 1 + sum(size(x) for x in edit.behind)

    for t in range(20_000):
        role = rng.choice(["user", "assistant", "user", "assistant", "system"])
        settled += len(repair.add(t, role, "text", rng.random() < 0.1, rng.random() < 0.2))
        most = max(most, size(repair.root))
    settled += len(repair.close()[1])
    assert settled >= 20_000 and most < 60


def test_edits_are_a_script(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Are you there?"), (1, 3, "assistant", "Yes."), (2, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [tuple(r)[:6] for r in conversations.edits(df).where("edit IS NOT NULL").orderBy("conv", "place").collect()]
    assert found == [
        (1, 0, "K", 0, "system", "Be kind."),
        (1, 1, "K", 1, "user", "Hi."),
        (1, 2, "I", None, "assistant", ""),
        (1, 3, "K", 2, "user", "Are you there?"),
        (1, 4, "K", 3, "assistant", "Yes."),
        (2, 0, "D", None, None, None),
    ]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 1, "user", "A."), (None, None, None, None), (None, 1, "user", "A."), (3, None, "user", "B."), (3, None, "assistant", "C.")]
    rows += [(4, 2, "user", "Q?")] * 5 + [(4, 2, "assistant", "x" * 100_000), (5, 9, "user", "\u0085.")]
    assert result(spark, rows) == {c: plain(r) for c, r in by_conversation(rows).items()}
    assert result(spark, []) == {}


def test_damage(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, i // 5]), rng.choice([None, i % 5]), rng.choice([None, "user", "system"]), rng.choice([None, "a.b!c?", ""])) for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted((tuple(r) for r in conversations.damaged(df).collect()), key=repr)
    assert found == sorted(damage(rows), key=repr)


@pytest.mark.skipif(not SMALLEST.exists(), reason="test tables not present")
def test_query_on_whole_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(SMALLEST / "conversations.parquet").to_pylist()]
    after = by_conversation(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = {c: plain(after[c]) if c in after else empty for c in by_conversation(rows)}
    df = catalog.op11_conversation_repair(spark, str(SMALLEST))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == expected
