"""Repair of conversations to the order system?, (user, assistant)+ by the cheapest edits, found by depth-first branch and bound.

Edits: Keep a turn (cost 0), Rerole it to user or assistant (1), Delete it (2; the only edit of blank and duplicate turns), Insert an empty user or assistant turn anywhere (5). A truncated
turn that isn't deleted costs 5 more. Of equally cheap repairs the one whose edits' initials come first in ASCII wins.

1. Faults. A turn's text is known by its SHA-256. A small aggregate finds the first turn of each (conversation, role, text); it becomes a marker row that sorts right before that turn.
2. Sorted ranges. Turns and markers are range-partitioned by conversation, turn, role and text hash, so a conversation of any number of turns is spread over as many ranges as it fills, and each
   range is read in order, batch by batch. A turn is a duplicate if no marker precedes it.
3. Search, in `branch_and_bound`. Turns are taken in blocks of up to 24: a node is (turn, last role), its children the edits possible there, kept on an explicit stack, best on top. Branches end where
   cost and least cost of the turns left (each turn's cheapest edit) can't beat the incumbent (cost, initials), or where the node's dominance table has a prefix as good, or a cheaper one in
   another state from which Inserts lead here. When the stack is empty the incumbent is proved. Costs add up over blocks, and of two equally cheap repairs of the same turns neither's initials begin the other's,
   so the best of a conversation is made of the best of its blocks between each pair of roles.
4. Conversations inside a range are done there. Those that its edges cut, at most two a range, are put together from one row a range, which holds the best repair between each pair of roles,
   and their text is then hashed in order, read as a stream (SHA-256 has no other way), never gathered.

Defined results: null roles and texts are one space, null turns come first. Turns that tie go by role, then by the SHA-256 of their text. A null conv_id is a conversation of its own. Roles are known by
their first letter; others than s, u and a can't be kept. Rows that repeat turn, role and text are duplicates of the first. Texts of any length are used whole; an empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CRC_TABLE, duck_crc32, small_batches, store, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED, BLOCK = 0, 1, 2, 5, 5, 24
#: What has been said: nothing, a system turn, a user turn last, an assistant turn last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {"su", "ua", "au"}
_FAR = 10**9
#: Inserts that lead from one state to another.
_INSERTS = [[0, _FAR, 1, 2], [_FAR, 0, 1, 2], [_FAR, _FAR, 0, 1], [_FAR, _FAR, 1, 0]]

Turn = tuple[str, bool, bool]  # first letter of the role, whether it must be deleted, whether it is truncated
Best = tuple[int, str]  # cost, initials


def _edits(turn: Turn, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, next state) of what can be done with a turn."""
    initial, bad, truncated = turn
    out = [(DELETE, "D", state)]
    if not bad:
        more = TRUNCATED if truncated else 0
        want, to = ("a", ASSISTANT) if state == USER else ("u", USER)
        if initial == want:
            out.append((KEEP + more, "K", to))
        else:
            out.append((REROLE + more, "R", to))
            if initial == "s" and state == NONE:
                out.append((KEEP + more, "K", SYSTEM))
    return out


def branch_and_bound(turns: list[Turn], start: int, goals: tuple[int, ...]) -> Best | None:
    """The cheapest edits of `turns` that lead from the state `start` to one of `goals`; None where none do."""
    n = len(turns)
    # The least that the turns from each one on can cost, whatever the roles around them.
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        initial, bad, truncated = turns[i]
        bound[i] = bound[i + 1] + (DELETE if bad or truncated else KEEP if initial in ("s", "u", "a") else REROLE)
    best: Best | None = None
    dominant: list[list[Best | None]] = [[None] * 4 for _ in range(n + 1)]
    stack = [(0, "", 0, start)]
    while stack:
        cost, edits, i, state = stack.pop()
        if best and (cost + bound[i], edits) > (best[0], best[1][: len(edits)]):
            continue
        row = dominant[i]
        if row[state] is not None and row[state] <= (cost, edits):
            continue
        if any(other and other[0] + INSERT * _INSERTS[s][state] < cost for s, other in enumerate(row)):
            continue
        row[state] = (cost, edits)
        if i == n and state in goals and (best is None or (cost, edits) < best):
            best = (cost, edits)
        nexts = [(cost + INSERT, edits + "I", i, ASSISTANT if state == USER else USER)]
        if i < n:
            nexts += [(cost + c, edits + e, i + 1, to) for c, e, to in _edits(turns[i], state)]
        stack += sorted(nexts, key=lambda node: (node[0] + bound[node[2]], node[1]), reverse=True)
    return best


def _extended(ways: dict[int, Best], blocks: list[dict[tuple[int, int], Best | None]], turns: list[list[Turn]]) -> dict[int, Best]:
    """The best ways to each state after further blocks of turns, from the best ways before; `blocks` keeps what was searched."""
    for found, block in zip(blocks, turns, strict=True):
        after: dict[int, Best] = {}
        for state, (cost, edits) in ways.items():
            for goal in range(4):
                if (state, goal) not in found:
                    found[state, goal] = branch_and_bound(block, state, (goal,))
                one = found[state, goal]
                if one:
                    way = (cost + one[0], edits + one[1])
                    after[goal] = min(after.get(goal, way), way)
        ways = after
    return ways


def best_ways(turns: list[Turn], starts: tuple[int, ...]) -> dict[int, dict[int, Best]]:
    """For each state before the turns, the best way to each state after them."""
    cut = [turns[i : i + BLOCK] for i in range(0, len(turns), BLOCK)]
    found: list[dict] = [{} for _ in cut]
    return {s: _extended({s: (0, "")}, found, cut) for s in starts}


def cheapest_repair(turns: list[Turn]) -> Best:
    """The edits that give a conversation the wanted roles, or none at all."""
    if len(turns) <= BLOCK:
        return branch_and_bound(turns, NONE, (NONE, ASSISTANT))
    ways = best_ways(turns, (NONE,))[NONE]
    return min(ways[g] for g in (NONE, ASSISTANT) if g in ways)


class Editor:
    """Applies initials to turns as they come: `turn` gives the (role, text) rows up to and with the next turn, `rest` those after the last."""

    def __init__(self, edits: str):
        self.edits, self.at, self.last = edits, 0, ""

    def _inserts(self) -> Iterator[tuple[str, str]]:
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._said("assistant" if self.last == "u" else "user", "")

    def _said(self, role: str, text: str) -> tuple[str, str]:
        self.last = role[:1]
        return role, text

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._said(role if edit == "K" else "assistant" if self.last == "u" else "user", text)

    rest = _inserts


def damaged(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) with known faults, by crc32 of `conv_id:turn`: copies is how often a row is there after that, 0 to 2."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))


_SPACE = " \t\n\x0b\x0c\r"
_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PIECE = f"{_DIGEST}, whole boolean, piece int, low long, high long, n_turns long, first_turn long, last_turn long, first_role string, last_role string, n long, costs array<long>, edits array<string>"


class _Piece:
    """One conversation's turns in a range, or as much of them as lies there."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.said, self.counts = conv_id, [], [], [0, 0, 0, 0]
        self.low = self.high = self.first_turn = self.last_turn = None
        self.n_turns, self.first_role, self.last_role = 0, None, None

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        end = text.rstrip(_SPACE)[-1:]
        fault = 0 if not end else 1 if not first else 2 if end not in ".!?" else None
        if fault is not None:
            self.counts[fault] += 1
        if self.last_role is not None and self.last_role + role[:1] not in LEGAL:
            self.counts[3] += 1
        if not self.turns:
            self.first_role, self.first_turn = role[:1], turn
        if turn is not None and turn != self.high:
            self.low, self.high, self.n_turns = turn if self.low is None else self.low, turn, self.n_turns + 1
        self.last_role, self.last_turn = role[:1], turn
        self.turns.append((role[:1], fault in (0, 1), fault == 2))
        self.said.append((role, text))

    def row(self, whole: bool, piece: int) -> dict:
        out = dict.fromkeys(name.split()[0] for name in _PIECE.split(", "))
        out |= dict(zip(("blank", "duplicate", "truncated", "illegal"), self.counts, strict=True), conv_id=self.conv_id, whole=whole, piece=piece)
        if whole:
            out["cost"], out["audit"] = cheapest_repair(self.turns)
            out["gaps"] = self.high - self.low + 1 - self.n_turns if self.n_turns else 0
            editor, sha = Editor(out["audit"]), _Lines()
            for role, text in self.said:
                sha.add(editor.turn(role, text))
            sha.add(editor.rest())
            out["repaired_sha256"] = sha.hexdigest()
            return out
        ways = best_ways(self.turns, (NONE, SYSTEM, USER, ASSISTANT))
        flat = [ways[s].get(g) for s in range(4) for g in range(4)]
        return out | dict(low=self.low, high=self.high, n_turns=self.n_turns, first_turn=self.first_turn, last_turn=self.last_turn, first_role=self.first_role, last_role=self.last_role,
                          n=len(self.turns), costs=[w and w[0] for w in flat], edits=[w and w[1] for w in flat])


class _Lines:
    """SHA-256 of `role:text` lines joined by line feeds."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, said: Iterator[tuple[str, str]]) -> None:
        for role, text in said:
            self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

    def hexdigest(self) -> str:
        return self.sha.hexdigest()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _PIECE from a range's rows in order; the first and last conversation may go on in other ranges."""
    part, piece, first, mark, out = TaskContext.get().partitionId(), None, True, None, []
    schema = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in _PIECE.split(", "))])
    for batch in batches:
        for conv, turn, role, digest, text, copies, is_marker in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "text", "copies", "marker")], strict=True):
            if piece is None or conv != piece.conv_id:
                if piece is not None:
                    out.append(piece.row(not first, part))
                    first = False
                piece = _Piece(conv)
            if is_marker:
                mark = (conv, turn, role, digest)
                continue
            for _ in range(copies):
                piece.add(turn, role, text, mark == (conv, turn, role, digest))
                mark = None
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if piece is not None:
        out.append(piece.row(False, part))
    yield pa.RecordBatch.from_pylist(out, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _joined(group: pa.Table) -> pa.Table:
    """One row of _DIGEST, without the hash, from a conversation's pieces."""
    pieces = sorted(group.to_pylist(), key=lambda p: p["piece"])
    out = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
    low, high, n_turns, last = None, None, 0, None
    ways: dict[int, Best] = {NONE: (0, "")}
    for p in pieces:
        if not p["n"]:
            continue
        if last is not None and last["last_role"] + p["first_role"] not in LEGAL:
            out["illegal"] += 1
        last = p
        if p["n_turns"]:
            n_turns += p["n_turns"] - (p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"]
        after: dict[int, Best] = {}
        for state, (cost, edits) in ways.items():
            for goal in range(4):
                if p["costs"][4 * state + goal] is not None:
                    way = (cost + p["costs"][4 * state + goal], edits + p["edits"][4 * state + goal])
                    after[goal] = min(after.get(goal, way), way)
        ways = after
    cost, audit = min(ways[g] for g in (NONE, ASSISTANT) if g in ways)
    out |= dict(conv_id=pieces[0]["conv_id"], gaps=high - low + 1 - n_turns if n_turns else 0, cost=cost, audit=audit)
    return pa.Table.from_pylist([out], pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in _DIGEST.split(", ")[:-1])]))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, str | None, str | None]]:
    """(conv_id, place, role, text) of repaired turns, from rows of whole conversations in order, each led by its audit; place -1 with nulls ends a conversation."""
    conv, editor, place = None, None, 0
    for batch in batches:
        for now, role, text, copies, audit in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "audit")], strict=True):
            if audit is not None:
                if editor is not None:
                    for said in editor.rest():
                        yield (conv, place := place + 1, *said)
                    yield conv, -1, None, None
                conv, editor, place = now, Editor(audit), 0
                continue
            for _ in range(copies):
                for said in editor.turn(role, text):
                    yield (conv, place := place + 1, *said)
    if editor is not None:
        for said in editor.rest():
            yield (conv, place := place + 1, *said)
        yield conv, -1, None, None


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines, out = _Lines(), []
    for conv, place, role, text in _edited(batches):
        if place < 0:
            out.append((conv, lines.hexdigest()))
            lines = _Lines()
        else:
            lines.add([(role, text)])
    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([h for _, h in out], pa.string())], names=["conv_id", "repaired_sha256"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, names = [], ["conv_id", "turn", "role", "text"]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=names)

    for conv, place, role, text in _edited(batches):
        if place > 0:
            out.append((conv, place - 1, role, text))
        if len(out) == 1000:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _counted(turns: DataFrame) -> DataFrame:
    """`turns` as rows to sort: without `copies`, each is there once; rows with no copies only say that the conversation exists."""
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


_ORDER = ("conv_id", "turn", "role", "digest")


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """`rows` of the conversations of `audits` (conv_id, audit), each after its audit, all of a conversation in one task, to be read as a stream."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(audits, allowMissingColumns=True)
    return both.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER[1:]).select("conv_id", "role", "text", "copies", "audit")


def repairs(turns: DataFrame) -> DataFrame:
    """For each conversation of `turns` (conv_id, turn, role, text; `copies` if each row stands for several): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    small_batches(turns.sparkSession)
    rows = _counted(turns)
    firsts = rows.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    markers = firsts.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(True).alias("marker"))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.withColumn("marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    ranges = both.repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER, F.col("marker").desc())
    found = store(ranges.mapInArrow(_pieces, _PIECE), "conversation-pieces")
    digest = [c.split()[0] for c in _DIGEST.split(", ")]
    cut = found.filter("NOT whole").select("conv_id", "piece", "blank", "duplicate", "truncated", "illegal", "low", "high", "n_turns", "first_role", "last_role", "n", "costs", "edits")
    joined = store(cut.groupBy("conv_id").applyInArrow(_joined, _DIGEST.rsplit(", ", 1)[0]), "cut-conversations")
    # At most two conversations a range.
    own = rows.drop("digest").withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    few = own.join(F.broadcast(joined.select(F.col("conv_id").alias("cut_id"))), F.col("conv_id").eqNullSafe(F.col("cut_id")), "left_semi").filter("copies > 0")
    hashes = _with_audits(few, joined.select("conv_id", "audit")).mapInArrow(_hashed, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "hashed_id")
    edges = joined.join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed_id"))).select(*digest)
    return found.filter("whole").select(*digest).unionByName(edges)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role, text."""
    return _with_audits(_counted(turns).filter("copies > 0"), repairs(turns).select("conv_id", "audit")).mapInArrow(_rows, "conv_id long, turn long, role string, text string")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs(damaged(table(spark, sf_dir, "conversations")))


def _sql_add(state: str, cost: int | str, edit: str) -> str:
    return f"(lpad(CAST(CAST({state}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {state}[10:] || '{edit}')"


def _sql_inserts(n: str, s: str, u: str, a: str) -> tuple[str, str]:
    """User and assistant states after any Inserts; a second one never leads back to a state more cheaply."""
    return f"least({u}, {_sql_add(n, 5, 'I')}, {_sql_add(s, 5, 'I')}, {_sql_add(a, 5, 'I')})", f"least({a}, {_sql_add(u, 5, 'I')})"


#: A dynamic program over turns instead of a search: for each last role, the cheapest cost in nine digits, then the initials.
OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {duck_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE fate WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
  regexp_extract(text, '([^ \\t\\n\\x0B\\f\\r])[ \\t\\n\\x0B\\f\\r]*$', 1) AS final FROM d),
f AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, role[1] AS ini, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM p),
o AS (SELECT *, fault IN ('blank', 'duplicate') AS bad, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM f),
s AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS n, '900000000' AS s, '900000000' AS u, '900000000' AS a FROM (SELECT DISTINCT conv_id FROM conversations)
 UNION ALL
 SELECT conv_id, i, {_sql_add('n', 2, 'D')}, least({_sql_add('s', 2, 'D')}, CASE WHEN NOT bad AND ini = 's' THEN {_sql_add('n', 'more', 'K')} ELSE '9' END),
  least({_sql_add('u', 2, 'D')}, CASE WHEN bad THEN '9' WHEN ini = 'u' THEN least({', '.join(_sql_add(x, 'more', 'K') for x in 'nsa')}) ELSE least({', '.join(_sql_add(x, 'more + 1', 'R') for x in 'nsa')}) END),
  least({_sql_add('a', 2, 'D')}, CASE WHEN bad THEN '9' WHEN ini = 'a' THEN {_sql_add('u', 'more', 'K')} ELSE {_sql_add('u', 'more + 1', 'R')} END)
 FROM (SELECT o.conv_id, o.i, bad, more, ini, n, s, u1 AS u, {_sql_inserts('n', 's', 'u1', 'a')[1]} AS a FROM
  (SELECT conv_id, i, n, s, {_sql_inserts('n', 's', 'u', 'a')[0]} AS u1, least(a, {_sql_add('u', 5, 'I')}) AS a FROM s) s JOIN o ON o.conv_id IS NOT DISTINCT FROM s.conv_id AND o.i = s.i + 1)),
e AS (SELECT conv_id, n, {_sql_inserts('n', 's', 'u1', 'a')[1]} AS a FROM (SELECT conv_id, n, a, s, {_sql_inserts('n', 's', 'u', 'a')[0]} AS u1 FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
r AS (SELECT conv_id, CAST(least(n, a)[1:9] AS BIGINT) AS cost, least(n, a)[10:] AS audit FROM e),
x AS (SELECT conv_id, audit, generate_subscripts(string_split(audit, ''), 1) AS k, unnest(string_split(audit, '')) AS ed FROM r WHERE audit <> ''),
y AS (SELECT *, count(*) FILTER (WHERE ed <> 'I') OVER w AS i, count(*) FILTER (WHERE ed <> 'D') OVER w AS said FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
z AS (SELECT y.conv_id, k, y.ed, said, CASE WHEN y.ed = 'I' THEN '' ELSE text END AS text, CASE WHEN y.ed = 'K' THEN role END AS kept,
  bool_or(y.ed = 'K' AND ini = 's') OVER (PARTITION BY y.conv_id) AS sys FROM y LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM y.conv_id AND o.i = y.i WHERE y.ed <> 'D'),
t AS (SELECT conv_id, string_agg(coalesce(kept, CASE WHEN (said - CAST(sys AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k) AS lines FROM z GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY conv_id)
SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
  sha256(coalesce(lines, '')) AS repaired_sha256 FROM r LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM r.conv_id
"""
