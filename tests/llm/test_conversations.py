"""Conversation repair against a search for the cheapest edits, best first."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from girder.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        changed = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, t, "user" if fate == 4 else role, changed)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def faults_of(turns):
    seen, out = set(), []
    for _, role, text in turns:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(turns, faults):
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(turns) and last in ("", "a"):
            return cost, audit, "\n".join(out)
        if (i, last) in done:
            continue
        done.add((i, last))
        initial, name = ("a", "assistant") if last == "u" else ("u", "user")
        heapq.heappush(heap, (cost + 3, audit + "I", i, initial, (*out, f"{name}:")))
        if i < len(turns):
            _, role, text = turns[i]
            more = 3 if faults[i] == "truncated" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if faults[i] not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, initial, (*out, f"{name}:{text}")))
                if role[:1] == initial or (role[:1] == "s" and not last):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))


def expected(rows):
    out, after = [], damaged(rows)
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in after if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faults_of(turns)
        cost, audit, text = cheapest(turns, faults)
        numbers = {t for t, _, _ in turns if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.append((c, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in conversations.repairs(conversations.damaged(df), df).collect()), key=str)


def odd_rows():
    rng = random.Random(5)
    rows = []
    for c in [None, *range(250)]:
        for k in range(rng.choice([0, 1, 2, 3, 5, 9])):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "User", "umpire"])
            rows.append((c, rng.choice([k, k, k, k // 2, None, -k]), role, rng.choice(["hi.", "hi", "what?", "\t\n", None, "", "x! ", "wörd.", "é", f"t{k}."])))
    return rows + rows[:40]


def long_rows():
    """Conversations of many blocks and segments, one with a single number for all its turns."""
    rng = random.Random(6)
    roles, texts = ["user", "assistant", "assistant", "system"], ["", "cut off", "whole."]
    rows = [(1, k, rng.choice(roles), rng.choice(texts) + (f" {k}." if rng.random() < 0.8 else "")) for k in range(700)]
    rows += [(2, 5, rng.choice(roles), f"same number {k}.") for k in range(300)]
    return rows + [(3, 1, "user", "same.")] * 300 + [(4, k % 3, "user", "x" * 50_000 + ".") for k in range(3)]


@pytest.mark.parametrize("rows", [odd_rows, long_rows])
def test_against_search(spark, rows):
    assert got(spark, rows()) == expected(rows())


def test_batches_of_few_rows(spark, monkeypatch):
    """Where a batch ends makes no difference."""
    turns = [(c, k, t) for c in range(40) for k, t in enumerate(range(c % 7))]
    rows = [(c, k, ["user", "assistant", "system"][(c * k) % 3], f"text {k}{'.' * (c % 2)}") for c, k, _ in turns]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert got(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repair_of_whole_conversations(spark):
    """Without damage: what is whole is kept; the rest gets the least edits."""
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "assistant", "a."), (2, 0, "assistant", "a."), (3, 0, "user", " "), (4, 0, "system", "s.")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in conversations.repairs(df, df).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found[1] == (0, "KKK", sha("system:s.\nuser:q?\nassistant:a."))
    assert found[2] == (3, "IK", sha("user:\nassistant:a.")) and found[3] == (4, "D", sha("")) and found[4] == (4, "D", sha(""))


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repairs(empty, empty).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "hi.", "x", 4)], SCHEMA + ", block string, cost long")
    assert conversations.repairs(df, df).first()["audit"] == "KI"
    assert conversations.repairs(df.where("conv_id = 2"), df).first()["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_sql(spark):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    rows = odd_rows()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    found = con.execute(conversations.ORACLE_SQL).fetchall()
    assert sorted((tuple(None if pd.isna(x) else x for x in r) for r in found), key=str) == expected(rows)
