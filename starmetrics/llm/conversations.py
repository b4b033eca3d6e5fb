"""Operator 13 — conversation structure repair by survivor-coalescence Viterbi.

Every row of a conversation is kept (K), given another role (R) or deleted (D), and rows with an empty text may be
inserted (I), so that the initials of the roles read ``(s?(ua)+)?``.  Of the cheapest edits the ASCII-least string of
initials counts.  The rows of a conversation come in order; a survivor is the best way into one of the four states of
that pattern.  Survivors point into a backpointer tree whose nodes count their references: a node that no survivor
needs any more goes, and a node that all survivors have in common is final, so its edits leave the tree at once.
The memory of a task therefore follows the rows that are still open, not the length of a conversation.

Ties compare the whole open suffixes of two survivors, but never walk them: the strings of two survivors end with the
edit of the same row, so none is the beginning of the other (they would differ by insertions at the end, which cost),
and what is appended to both leaves their order alone.  Each survivor carries its place in that order.

The rows of a conversation are hashed in order into one SHA-256, which can't be cut; they stream through one task as
sorted batches.  Everything else (damage, faults, duplicates) is made by Spark expressions.

Edge cases: null roles and texts count as one space, and so do null ids and turns in the string whose CRC-32 picks the
damage; a null conv_id is a conversation of its own; a null turn comes first; rows of equal turn come by role, then
text (by UTF-8 bytes); repeated rows are duplicates; a role that starts with none of s, u, a can't be kept; a
conversation whose rows are all dropped has zeros, an empty audit and the hash of the empty string; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmetrics.llm.common import SPACES, table

#: Costs of the edits, and what a truncated row that stays adds.
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: The pattern (s?(ua)+)? as states: 0 nothing yet, 1 after s, 2 after u, 3 after a; initial → next state.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped``: rows emptied, stripped of end marks, repeated or turned into the user's;
    a dropped row stays as a mark that its conversation exists."""
    def string(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn")).cast("binary")) % 20
    hurt = rows.select("conv_id", "turn", string("role").alias("role"), string("text").alias("text"), kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").when(F.col("kind") != 0, F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).when(F.col("kind") != 0, F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return hurt.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def judged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` with ``fault``: blank, duplicate, truncated or null.  One shuffle, by
    conversation: the window groups inside it, and the rows come out in order."""
    rows = rows.repartition("conv_id")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)  # no text in the sort
    seen = F.row_number().over(Window.partitionBy("conv_id", same).orderBy(F.col("turn").asc_nulls_first()))
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(F.col("dropped"), None).when(body == "", "blank").when(F.col("_seen") > 1, "duplicate")
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated"))
    return (rows.withColumn("_seen", seen).withColumn("fault", fault)
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_seen").drop("_seen"))


def _inserted(q: int) -> list[tuple[int, str]]:
    """States that up to two insertions reach from q, with their initials; a longer way only costs more."""
    out, at, ext = [(q, "")], q, ""
    for _ in range(2):
        at = next(n for c, n in NEXT[at].items() if c in ROLES)
        ext += "I"
        if at != q:
            out.append((at, ext))
    return out


def _cost(ext: str, truncated: bool) -> int:
    return sum(COST[e] for e in ext) + (TRUNCATED if truncated and ext[-1] != "D" else 0)


def _moves(initial: str, delete: bool, truncated: bool) -> list[list[tuple[int, int, str]]]:
    """For each next state, the cheapest way of one row from each state: (from, cost, edits)."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for q in range(4):
        for at, ext in _inserted(q):
            ways = [(at, "D")]
            if not delete:
                ways += [(n, "K") for c, n in NEXT[at].items() if c == initial]
                ways += [(n, "R") for c, n in NEXT[at].items() if c in ROLES]
            for n, e in ways:
                w = (_cost(ext + e, truncated), ext + e)
                best[q, n] = min(best.get((q, n), w), w)
    return [[(q, *best[q, n]) for q in range(4) if (q, n) in best] for n in range(4)]


_NEUTRAL = "-"
MOVES = {(i, d, t): _moves(i, d, t) for i in ("s", "u", "a", _NEUTRAL) for d in (False, True) for t in (False, True)}
#: Edits after the last row, by state: the cheapest way to an end of the pattern.
LAST = {q: min((sum(COST[e] for e in ext), ext) for at, ext in _inserted(q) if at in ENDS) for q in range(4)}


#: What it costs at most to follow from one state the edits meant for another: insertions that lead there, the end of
#: the pattern, and deleting an s that only state 0 may keep.  A survivor dearer than that never wins.
FOLLOW = {(0, 1): 0, (0, 2): 3, (0, 3): 0, (1, 0): 6, (1, 2): 3, (1, 3): 6, (2, 0): 7, (2, 1): 3, (2, 3): 3, (3, 0): 4, (3, 1): 0, (3, 2): 3}


class Node:
    """Edits of one row on a survivor's way; ``heirs`` are the nodes (or the survivor) that still need it."""
    __slots__ = ("ext", "state", "row", "parent", "heirs")

    def __init__(self, ext: str, state: int, row, parent: Node | None):
        self.ext, self.state, self.row, self.parent, self.heirs = ext, state, row, parent, set()


class Repair:
    """The rows of one conversation, one after the other.  ``step`` and ``end`` give the edits that became final:
    (edit, role, text, turn), role and text of what stays (None for a deletion)."""

    def __init__(self):
        self.root = Node("", 0, None, None)
        self.best: dict[int, tuple[int, int, Node]] = {0: (0, 0, self.root)}  # state → cost, place among ties, node
        self.open = 1  # nodes in the tree
        self.most = 1

    def step(self, turn, role: str, text: str, delete: bool, truncated: bool) -> list[tuple]:
        initial = role[:1] if role[:1] in ("s", "u", "a") else _NEUTRAL
        row, ways = (turn, role, text), []
        for n, froms in enumerate(MOVES[initial, delete, truncated]):
            own = [(self.best[q][0] + c, self.best[q][1], ext, q) for q, c, ext in froms if q in self.best]
            if own:
                ways.append((*min(own), n))
        ways = [w for w in ways if not any(v[0] + FOLLOW[v[4], w[4]] < w[0] for v in ways if v is not w)]
        ways.sort(key=lambda w: (w[1], w[2]))  # order of the strings
        new = {}
        for place, (cost, _, ext, q, n) in enumerate(ways):
            parent = self.best[q][2]
            node = Node(ext, q, row, parent)
            parent.heirs.add(node)
            new[n] = (cost, place, node)
        self.open += len(new)
        for _, _, node in self.best.values():  # former survivors that nothing follows leave, and so do their parents
            while node is not self.root and not node.heirs:
                node.parent.heirs.discard(node)
                node, self.open = node.parent, self.open - 1
        self.best = new
        self.most = max(self.most, self.open)
        return self._final()

    def _final(self) -> list[tuple]:
        """Passes from the root down while there is one heir only."""
        out: list[tuple] = []
        while len(self.root.heirs) == 1:
            (child,) = self.root.heirs
            out += _edits(child.ext, child.state, child.row)
            child.parent = None
            self.root, self.open = child, self.open - 1
        return out

    def end(self) -> tuple[int, list[tuple]]:
        """The cost of all edits, and the edits still open."""
        cost, _, ext, q = min((c + LAST[q][0], place, LAST[q][1], q) for q, (c, place, _) in self.best.items())
        node, way = self.best[q][2], []
        while node is not self.root:
            way.append(node)
            node = node.parent
        out = [e for n in reversed(way) for e in _edits(n.ext, n.state, n.row)]
        return cost, out + _edits(ext, q, None)


def _edits(ext: str, state: int, row) -> list[tuple]:
    out = []
    for e in ext:
        if e == "D":
            out.append((e, None, None, row[0]))
        elif e == "K":
            out.append((e, row[1], row[2], row[0]))
            state = NEXT[state][row[1][0]]
        else:
            c = next(c for c in NEXT[state] if c in ROLES)
            out.append((e, ROLES[c], row[2] if e == "R" else "", row[0] if e == "R" else None))
            state = NEXT[state][c]
    return out


class Digest:
    """Counts of one conversation, its edits' initials, and the hash of its repaired rows."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.hash, self.started = conv_id, [], hashlib.sha256(), False
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.low = self.high = None
        self.distinct = self.illegal = 0
        self.before: str | None = None

    def row(self, turn, role: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]

    def edits(self, edits: list[tuple]) -> None:
        for e, role, text, _ in edits:
            self.audit.append(e)
            if e != "D":
                self.hash.update((("\n" if self.started else "") + role + ":" + text).encode())
                self.started = True

    def result(self, cost: int) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.hash.hexdigest())


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turn, role, text, dropped, fault, whether a conversation starts) of every row in order."""
    last = object()
    for b in batches:
        for r in zip(*[b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped", "fault")]):
            yield (*r, r[0] != last)
            last = r[0]


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``judged`` rows: the columns of the query."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {DIGEST}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *[c.split()[0] for c in DIGEST.split(", ")]]
        out: list[tuple] = []
        repair = told = arrow = None

        def flush():
            cols = [pa.array(c, t) for c, t in zip(zip(*out), [arrow, *[pa.int64()] * 6, pa.string(), pa.string()])]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names)

        def close():
            cost, rest = repair.end()
            told.edits(rest)
            out.append(told.result(cost))

        def typed():
            nonlocal arrow
            for b in batches:
                arrow = b.column("conv_id").type
                yield b

        for conv, turn, role, text, dropped, fault, new in _conversations(typed()):
            if new:
                if told:
                    close()
                    if len(out) >= 10_000:
                        yield flush()
                repair, told = Repair(), Digest(conv)
            if not dropped:
                told.row(turn, role, fault)
                told.edits(repair.step(turn, role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        if told:
            close()
            yield flush()

    return rows.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The edits themselves, in order: ``conv_id, step, edit, turn, role, text`` (role and text are what stays, null
    for a deletion; turn is null for an insertion).  ``rows`` as ``judged`` gives them."""
    kind, turns = rows.schema["conv_id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, step long, edit string, turn {turns}, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = []
        out: list[tuple] = []

        def typed():
            for b in batches:
                arrow[:] = [b.column("conv_id").type, pa.int64(), pa.string(), b.column("turn").type, pa.string(), pa.string()]
                yield b

        def flush():
            cols = [pa.array(c, t) for c, t in zip(zip(*out), arrow)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, ["conv_id", "step", "edit", "turn", "role", "text"])

        work, at, conv = None, 0, None

        def put(edits):
            nonlocal at
            for e, role, text, turn in edits:
                out.append((conv, at, e, turn, role, text))
                at += 1

        for c, turn, role, text, dropped, fault, new in _conversations(typed()):
            if new:
                if work:
                    put(work.end()[1])
                work, at, conv = Repair(), 0, c
            if not dropped:
                put(work.step(turn, role, text, fault in ("blank", "duplicate"), fault == "truncated"))
            if len(out) >= 10_000:
                yield flush()
        if work:
            put(work.end()[1])
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(judged(damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


def sql() -> str:
    """The same rows by a recursive query that carries whole strings: row by row, the least (cost, initials) of each state."""
    return r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), c AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
                     lambda h, b: xor(h // 256, list_extract(crc.t, (xor(h, b) % 256) + 1))) AS h
  FROM conversations, crc
), k AS (
  SELECT *, xor(h, 4294967295) % 20 AS kind FROM c
), d AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE kind <> 0
), n AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM d
), f AS (
  SELECT conv, i, turn, role, text, left(role, 1) AS initial,
         CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before
  FROM n
), ins(q, mid, ext, rep) AS (
  VALUES (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
         (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
         (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')
), way(mid, nxt, edit, initial, role) AS (
  VALUES (0, 1, 'K', 's', NULL), (0, 2, 'K', 'u', NULL), (1, 2, 'K', 'u', NULL), (2, 3, 'K', 'a', NULL), (3, 2, 'K', 'u', NULL),
         (0, 2, 'R', NULL, 'user'), (1, 2, 'R', NULL, 'user'), (2, 3, 'R', NULL, 'assistant'), (3, 2, 'R', NULL, 'user'),
         (0, 0, 'D', NULL, NULL), (1, 1, 'D', NULL, NULL), (2, 2, 'D', NULL, NULL), (3, 3, 'D', NULL, NULL)
), move AS (
  SELECT ins.q, way.nxt, ins.ext || edit AS ext, ins.rep, edit, initial, role,
         3 * length(ins.ext) + CASE edit WHEN 'R' THEN 3 WHEN 'D' THEN 4 ELSE 0 END AS cost
  FROM ins JOIN way ON ins.mid = way.mid
), s AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, 0 AS q, {'cost': 0::BIGINT, 'audit': '', 'rep': ''} AS best FROM c
  UNION ALL
  SELECT conv, i, nxt, min(best) FROM (
    SELECT s.conv, f.i, m.nxt, {'cost': s.best.cost + m.cost + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 3 ELSE 0 END, 'audit': s.best.audit || m.ext,
           'rep': s.best.rep || m.rep || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || m.role || ':' || f.text END} AS best
    FROM s JOIN f ON f.conv = s.conv AND f.i = s.i + 1 JOIN move m ON m.q = s.q
    WHERE (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (m.edit <> 'K' OR m.initial = f.initial)
  ) GROUP BY conv, i, nxt
), z AS (
  SELECT conv, min({'cost': best.cost + 3 * length(ext), 'audit': best.audit || ext, 'rep': best.rep || ins.rep}) AS best
  FROM (SELECT *, max(i) OVER (PARTITION BY conv) AS last FROM s) e JOIN ins ON ins.q = e.q AND ins.mid IN (0, 3) WHERE i = last GROUP BY conv
), g AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, z.best.cost::BIGINT AS cost, z.best.audit AS audit,
       sha256(substr(z.best.rep, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM c) o JOIN z ON z.conv = o.conv LEFT JOIN g ON g.conv = o.conv"""
