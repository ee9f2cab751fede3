"""Conversation structure repair: the cheapest edits that give each conversation the turns (system? (user assistant)+)?.

1. Spark reads off each turn what the repair asks for: the role's initial, whether its text is blank, was seen earlier in
   the conversation, or is cut off.
2. Turns are partitioned by hash of conversation and block of BLOCK turn numbers, so a conversation of any length spreads
   over tasks. In a task, batches of segments of at most PIECE turns go to a recursive DuckDB query: each recursion
   advances all segments of the batch by one turn and keeps the least cost and, of equal costs, the ASCII-least audit for
   each state of the grammar, from each state that a segment may begin in.
3. The same query then advances all conversations by one segment in each recursion, from the grammar's start.
4. An audit is cut into its segments' edits. Segments are repaired where their turns are, and the repaired text of a
   conversation is hashed as a stream of segments, the only step in which one conversation is one task's.

Costs and audits of segments may be put together like that because edits of one segment, from one state to another,
cost the same in any context, and of two audits of the same turns at the same cost neither is the other's beginning.

States: 0 nothing yet, 1 after the system's turn, 2 after the user's, 3 after the assistant's. System turns are only
kept, never made. An empty table has an empty result. Nulls in role and text count as one space each; a null conv_id is a
conversation, turns without a number come first, and turns of one number are in the order of role and text. Rows that
repeat are duplicates from the second on. Other columns are ignored, whatever their names. A conversation without turns
costs nothing and has an empty audit. Texts are read whole; each goes to Python once, to be hashed.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, table, written

#: Turn numbers of a block, turns of a segment, and turns, or segments, that go to DuckDB at once.
BLOCK, PIECE, BATCH = 128, 128, 4096
#: Characters of repaired text in one row.
CHUNK = 1 << 20
BLANKS, ENDS = " \t\n\x0b\f\r", ".!?"
START, ACCEPT = 0, (0, 3)
#: What a turn of an initial leads to; inserted and re-roled turns are the user's or the assistant's.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3


def _inserts(state: int) -> Iterator[tuple[int, int]]:
    """(state, inserts) that inserts lead to from a state; more than two go round in circles."""
    for n in range(3):
        yield state, n
        state = NEXT[state, "a" if state == 2 else "u"]


def moves() -> pd.DataFrame:
    """a, b, initial (null: any), kept (the turn stays in some form), cost, audit: how one turn leads from state a to b."""
    out = [(a, a, None, False, DELETE, "D") for a in range(4)]
    for a in range(4):
        for mid, n in _inserts(a):
            for (state, initial), b in NEXT.items():
                if state == mid:
                    out.append((a, b, initial, True, INSERT * n, "I" * n + "K"))
                    if initial in ROLES:
                        out.append((a, b, None, True, INSERT * n + REROLE, "I" * n + "R"))
    return pd.DataFrame(out, columns=["a", "b", "initial", "kept", "cost", "audit"])


def endings() -> list[tuple[int, int, str]]:
    """(state, cost, audit) of the inserts that end a conversation, the cheapest for each state."""
    best: dict[int, tuple[int, str]] = {}
    for a in range(4):
        for b, n in _inserts(a):
            if b in ACCEPT:
                best[a] = min(best.get(a, (INSERT * n, "I" * n)), (INSERT * n, "I" * n))
    return [(a, *x) for a, x in best.items()]


#: starts (k, s: where k began, b: state, cost, audit) and steps (k, pos, a, b, cost, audit) to where each k ends.
ADVANCE = """
WITH RECURSIVE reached (k, s, pos, b, cost, audit) USING KEY (k, s, b) AS (
  SELECT k, s, 0::BIGINT, b, cost, audit FROM starts
  UNION
  SELECT k, s, pos, b, x.cost, x.audit FROM (
    SELECT r.k, r.s, r.pos + 1 AS pos, t.b, min(struct_pack(cost := r.cost + t.cost, audit := r.audit || t.audit)) AS x
    FROM reached r JOIN steps t ON t.k = r.k AND t.pos = r.pos + 1 AND t.a = r.b GROUP BY r.k, r.s, r.pos, t.b))
SELECT r.k, r.s, r.b, r.cost, r.audit FROM reached r JOIN (SELECT k, max(pos) AS pos FROM steps GROUP BY k) e ON e.k = r.k AND e.pos = r.pos ORDER BY ALL
"""
#: The steps of turns (k, pos, initial, bad, cut).
OF_TURNS = f"""
CREATE OR REPLACE TEMP TABLE steps AS SELECT t.k, t.pos, m.a, m.b, m.cost + CASE WHEN m.kept AND t.cut THEN {CUT_OFF} ELSE 0 END AS cost, m.audit
FROM turns t JOIN moves m ON (m.initial IS NULL OR m.initial = t.initial) AND NOT (m.kept AND t.bad)
"""
ALL_STARTS = "CREATE OR REPLACE TEMP TABLE starts AS SELECT DISTINCT t.k, s.s, s.s AS b, 0::BIGINT AS cost, '' AS audit FROM turns t, range(4) s(s)"


def _connection() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute("SET memory_limit = '400MB'")
    con.register("moves", moves())
    return con


#: A segment: its counts, the initials at its ends, and what leads through it from state s to state b.
SEGMENT = {"conv_id": "long", "block": "long", "piece": "int", "n": "int", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
    "head": "string", "tail": "string", "ways": "array<struct<s:int,b:int,cost:long,audit:string>>"}
#: A segment's edits and the state that it begins in; and, without piece, what is known of a whole conversation, with the text of the turns that end it.
PLAN = {"conv_id": "long", "block": "long", "piece": "int", "state": "int", "edits": "string", "blank": "long", "duplicate": "long", "truncated": "long",
    "illegal": "long", "cost": "long", "audit": "string"}
REPAIRED = {"conv_id": "long", "last": "boolean", "block": "long", "piece": "int", "seq": "int", "repaired": "string"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _clean(batch: pd.DataFrame, *columns: str) -> Iterator[tuple]:
    """Rows as tuples, with None for nulls."""
    return zip(*[batch[c].astype(object).where(batch[c].notna(), None) for c in columns], strict=True)


def legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


class _Segment:
    """A run of a conversation's turns: its counts, and what DuckDB needs of each turn."""

    def __init__(self, conv_id: int | None, block: int | None, piece: int):
        self.key, self.turns, self.illegal = (conv_id, block, piece), [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, initial: str, fault: str | None) -> None:
        if self.turns:
            self.illegal += not legal(self.turns[-1][0] + initial)
        if fault:
            self.faults[fault] += 1
        self.turns.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def row(self, ways: list[dict]) -> tuple:
        return *self.key, len(self.turns), *self.faults.values(), self.illegal, self.turns[0][0], self.turns[-1][0], ways


def _ways(con: duckdb.DuckDBPyConnection, segments: list[_Segment]) -> pd.DataFrame:
    """The segments with their costs and audits from each state to each."""
    turns = [(k, pos, *turn) for k, s in enumerate(segments) for pos, turn in enumerate(s.turns, 1)]
    con.register("turns", pd.DataFrame(turns, columns=["k", "pos", "initial", "bad", "cut"]))
    con.execute(OF_TURNS)
    con.execute(ALL_STARTS)
    ways: list[list[dict]] = [[] for _ in segments]
    for k, s, b, cost, audit in con.execute(ADVANCE).fetchall():
        ways[k].append({"s": s, "b": b, "cost": cost, "audit": audit})
    return pd.DataFrame([x.row(w) for x, w in zip(segments, ways, strict=True)], columns=list(SEGMENT))


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of turns that come in the order of conversations and blocks."""
    con, ready, now, before, size = _connection(), [], None, None, 0
    for batch in batches:
        for conv_id, block, turn, role, text, initial, blank, again, cut in _clean(batch, "conv_id", "block", "turn", "role", "text", "initial", "blank", "again", "cut"):
            same = now is not None and now.key[:2] == (conv_id, block)
            if not same or len(now.turns) == PIECE:
                ready += [now] if now else []
                if size >= BATCH:
                    yield _ways(con, ready)
                    ready, size = [], 0
                now = _Segment(conv_id, block, now.key[2] + 1 if same else 0)
            before, row = before if same else None, (turn, role, text)
            now.add(initial, "blank" if blank else "duplicate" if again or row == before else "truncated" if cut else None)
            before, size = row, size + 1
    if now:
        yield _ways(con, [*ready, now])


def _cut_at(audit: str, at: int, turns: int) -> int:
    """Where the edits of the next so many turns end; inserts belong to the turn that they come before."""
    for _ in range(turns):
        while audit[at] == "I":
            at += 1
        at += 1
    return at


def _state(emitted: int, system: bool) -> int:
    """The state after so many turns of a repaired conversation that has or lacks a system turn."""
    if not emitted:
        return START
    return 1 if system and emitted == 1 else 2 + (emitted - system + 1) % 2


class _Conversation:
    """What is known of a conversation: its segments and counts, and the least cost and audit in each state after them."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.segments, self.counts, self.tail = conv_id, [], [0, 0, 0, 0], None
        self.reached: list[tuple[int, int, str]] = [(START, 0, "")]

    def add(self, segment: tuple, counts: tuple, head: str, tail: str) -> None:
        self.counts = [x + y for x, y in zip(self.counts, counts, strict=True)]
        self.counts[-1] += self.tail is not None and not legal(self.tail + head)
        self.tail = tail
        self.segments.append(segment)

    def rows(self) -> Iterator[tuple]:
        cost, audit = min((c + more, a + inserts) for b, c, a in self.reached for end, more, inserts in endings() if end == b)
        system = (len(audit) - audit.count("D")) % 2 == 1
        at = emitted = 0
        for block, piece, n in self.segments:
            end = _cut_at(audit, at, n)
            yield (self.conv_id, block, piece, _state(emitted, system), audit[at:end], *[None] * 6)
            emitted += end - at - audit.count("D", at, end)
            at = end
        made = "".join(_turn(role, "") for role, _ in _made(_state(emitted, system), len(audit) - at))
        yield self.conv_id, None, None, None, made, *self.counts, cost, audit


def _turn(role: str, text: str) -> str:
    return f"\n{role}:{text}"


def _made(state: int, n: int) -> Iterator[tuple[str, int]]:
    """(role, state after it) of turns that the repair makes from a state on."""
    for _ in range(n):
        initial = "a" if state == 2 else "u"
        state = NEXT[state, initial]
        yield ROLES[initial], state


def _advanced(con: duckdb.DuckDBPyConnection, found: list[_Conversation], steps: list[tuple]) -> None:
    """Takes conversations as far as steps (k, pos, a, b, cost, audit) lead."""
    starts = [(k, START, b, cost, audit) for k, c in enumerate(found) for b, cost, audit in c.reached]
    con.register("starts", pd.DataFrame(starts, columns=["k", "s", "b", "cost", "audit"]))
    con.register("steps", pd.DataFrame(steps, columns=["k", "pos", "a", "b", "cost", "audit"]))
    for k in {step[0] for step in steps}:
        found[k].reached = []
    for k, _, b, cost, audit in con.execute(ADVANCE).fetchall():
        found[k].reached.append((b, cost, audit))
    con.unregister("starts")
    con.unregister("steps")


def _plans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits, from segments in the order of conversations; the last conversation of a batch waits, with what it has reached."""
    con, found, steps, pos = _connection(), [], [], 0
    for batch in chain(batches, (None,)):
        for conv_id, block, piece, n, head, tail, ways, *counts in _clean(batch, "conv_id", "block", "piece", "n", "head", "tail", "ways", "blank", "duplicate",
                "truncated", "illegal") if batch is not None else ():
            if not found or found[-1].conv_id != conv_id:
                found.append(_Conversation(conv_id))
                pos = 0
            pos += 1
            found[-1].add((block, piece, n), counts, head, tail)
            steps += [(len(found) - 1, pos, w["s"], w["b"], w["cost"], w["audit"]) for w in ways]
            if len(steps) >= 4 * BATCH:
                _advanced(con, found, steps)
                if done := [row for c in found[:-1] for row in c.rows()]:
                    yield pd.DataFrame(done, columns=list(PLAN))
                found, steps, pos = found[-1:], [], 0
    if steps:
        _advanced(con, found, steps)
    if found:
        yield pd.DataFrame([row for c in found for row in c.rows()], columns=list(PLAN))


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired text in chunks, from rows in the order of conversations and blocks; a block's edits come before its turns."""
    key, plans, at, state, seq, text = None, deque(), 0, START, 0, []
    for batch in batches:
        out = []
        columns = ("conv_id", "block", "kind", "piece", "state", "edits", "role", "initial", "text")
        for conv_id, block, kind, piece, begins, edits, role, initial, body in _clean(batch, *columns):
            if key != (conv_id, block):
                key, at = (conv_id, block), 0
                plans.clear()
            if kind == 0:
                plans.append((piece, begins, edits))
                continue
            piece, begins, edits = plans[0]
            if at == 0:
                state, seq = begins, 0
            while edits[at] == "I":
                for made, state in _made(state, 1):
                    text.append(_turn(made, ""))
                at += 1
            if edits[at] == "K":
                state = NEXT[state, initial]
                text.append(_turn(role, body))
            elif edits[at] == "R":
                for made, state in _made(state, 1):
                    text.append(_turn(made, body))
            at += 1
            if at == len(edits) or sum(map(len, text)) >= CHUNK:
                if text:
                    out.append((conv_id, False, block, piece, seq, "".join(text)))
                text, seq = [], seq + 1
            if at == len(edits):
                plans.popleft()
                at = 0
        if out:
            yield pd.DataFrame(out, columns=list(REPAIRED))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each conversation's chunks, which come in order, without the newline that the first begins with."""
    key, sha, out = None, None, []
    for batch in batches:
        for conv_id, text in _clean(batch, "conv_id", "repaired"):
            if sha is None or key != conv_id:
                if sha is not None:
                    out.append((key, sha.hexdigest()))
                key, sha, text = conv_id, hashlib.sha256(), text[1:]
            sha.update(text.encode())
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})
            out = []
    if sha is not None:
        yield pd.DataFrame([(key, sha.hexdigest())], columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})


def marked(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with block, hash, initial, and whether the text is blank, was seen at an earlier turn number (again), and is cut off."""
    stripped, block = F.rtrim(F.col("text"), F.lit(BLANKS)), F.floor(F.col("turn") / BLOCK)
    own = turns.select("conv_id", "turn", "role", "text", block.alias("block"), F.md5("text").alias("hash"), F.substring("role", 1, 1).alias("initial"),
        (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(*ENDS)).alias("cut"))
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    first = own.groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("hash").alias("f_hash")).agg(F.min(number).alias("first"))
    met = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("hash") == F.col("f_hash"))
    return own.join(first, met).withColumn("again", ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("f_conv", "f_role", "f_hash", "first")


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: what a fixed share of all rows loses, by the hash of conversation and turn."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate, text = F.crc32(name) % 20, F.coalesce(F.col("text"), space)
    changed = F.when(fate == 1, "").when(fate == 2, F.translate(text, ENDS, "")).otherwise(text)
    role = F.when(fate == 4, "user").otherwise(F.coalesce(F.col("role"), space))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1)))
    return rows.where(fate != 0).select("conv_id", "turn", role.alias("role"), changed.alias("text"), copies.alias("copy")).drop("copy")


def repairs(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conv_id of conversations; turns: conv_id, turn, role, text."""
    rows = written(marked(turns), "turns")
    in_blocks = rows.repartition("conv_id", "block")
    segments = written(in_blocks.sortWithinPartitions("conv_id", "block", "turn", "role", "text").mapInPandas(_segments, _ddl(SEGMENT)), "segments")
    plans = written(segments.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece").mapInPandas(_plans, _ddl(PLAN)), "plans")

    of_turns = rows.select("conv_id", "block", F.lit(1).alias("kind"), "turn", "role", "initial", "text")
    of_plans = plans.where("piece IS NOT NULL").select("conv_id", "block", F.lit(0).alias("kind"), "piece", "state", "edits")
    both = of_plans.unionByName(of_turns, allowMissingColumns=True).repartition("conv_id", "block")
    chunks = both.sortWithinPartitions("conv_id", "block", "kind", "piece", "turn", "role", "text").mapInPandas(_repaired, _ddl(REPAIRED))
    ends = plans.where("piece IS NULL AND edits != ''").select("conv_id", F.lit(True).alias("last"), F.col("block"), "piece", F.lit(0).alias("seq"), F.col("edits").alias("repaired"))
    in_order = chunks.union(ends).repartition("conv_id").sortWithinPartitions("conv_id", "last", "block", "piece", "seq")
    hashes = in_order.mapInPandas(_hashed, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "h_conv")

    numbers = rows.groupBy("conv_id", "turn").agg(F.count("*")).groupBy(F.col("conv_id").alias("g_conv")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    whole = plans.where("piece IS NULL").select(F.col("conv_id").alias("p_conv"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    found = conversations.select("conv_id").distinct()
    for side, key in ((numbers, "g_conv"), (whole, "p_conv"), (hashes, "h_conv")):
        found = found.join(side, F.col("conv_id").eqNullSafe(F.col(key)), "left").drop(key)
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    result = written(found.select("conv_id", *zero, *empty), "repairs")
    drop(rows, segments, plans)
    return result


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repairs(damaged(rows), rows)


#: The same edits, each conversation as a whole, with the repaired text carried along; crc32 bit by bit.
ORACLE_SQL = r"""
WITH RECURSIVE k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(name, ''), lambda x: ord(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)),
    4294967295::UBIGINT) % 20 AS fate FROM k),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM h, range(2) c(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
o AS (SELECT *, left(role, 1) AS ch, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM d),
f AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(ch) OVER (PARTITION BY conv_id ORDER BY pos) || ch AS pair FROM o),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS last FROM f GROUP BY conv_id),
g (a, ch, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
made (a, n, b, made) AS (VALUES (0, 0, 0, ''), (0, 1, 2, chr(10) || 'user:'), (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 0, 1, ''), (1, 1, 2, chr(10) || 'user:'),
    (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 0, 2, ''), (2, 1, 3, chr(10) || 'assistant:'), (3, 0, 3, ''), (3, 1, 2, chr(10) || 'user:')),
e AS (SELECT conv_id, pos, a, a AS b, 4 AS cost, 'D' AS audit, '' AS out FROM f, range(4) s(a)
  UNION ALL SELECT conv_id, pos, m.a, g.b, 3 * m.n + if(fault = 'truncated', 3, 0), repeat('I', m.n) || 'K', made || chr(10) || role || ':' || text
    FROM f JOIN g ON g.ch = f.ch JOIN made m ON m.b = g.a WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, m.a, g.b, 3 * m.n + 3 + if(fault = 'truncated', 3, 0), repeat('I', m.n) || 'R', made || chr(10) || if(g.ch = 'u', 'user', 'assistant') || ':' || text
    FROM f JOIN g ON g.ch <> 's' JOIN made m ON m.b = g.a WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')),
p (conv_id, pos, a, cost, audit, out) AS (SELECT conv_id, 0::BIGINT, 0, 0::BIGINT, '', '' FROM n UNION ALL
  SELECT conv_id, pos, b, x.cost, x.audit, x.out FROM (SELECT p.conv_id, e.pos, e.b, min(struct_pack(cost := p.cost + e.cost, audit := p.audit || e.audit, out := p.out || e.out)) AS x
    FROM p JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.pos = p.pos + 1 AND e.a = p.a GROUP BY p.conv_id, e.pos, e.b)),
w AS (SELECT p.conv_id, min(struct_pack(cost := p.cost + 3 * m.n, audit := audit || repeat('I', m.n), out := p.out || made)) AS x
  FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.last = p.pos JOIN made m ON m.a = p.a AND m.b IN (0, 3) GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(x.cost, 0)::BIGINT AS cost, coalesce(x.audit, '') AS audit, sha256(coalesce(x.out[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""
