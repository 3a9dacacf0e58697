"""Conversations put into turn order again, with the fewest edits.

Turns must alternate: an optional system turn, then pairs of user and
assistant.  The target is a string of initials, ``(s?(ua)+)?``; its length says
which one.  Turns are aligned to the targets of all feasible lengths by the
table of Wagner and Fischer: a cell is the least cost of the turns from i on
against the last j initials of a target.  Targets of all lengths end alike, so
their tables are one table; only a leading ``s`` is a step of its own.  The
band of the table that is filled is Ukkonen's: a quick valid repair gives an
incumbent cost, and cells through which every path costs more are left out.
From each length of least cost the audit is traced back, always by the least
letter, and the least audit of all lengths wins.

In a very long conversation the band would be wide.  There, columns of the same
parity, which have the same rest of the alphabet before them, are folded into
one; costs and audits are the same.

Spark deals the turns by conversation and sorts them; a task reads them as a
stream and holds a letter and a hash per turn of one conversation, never its
texts.  Texts go past a second time, with the audit in front.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, read
from shelfwise.llm.registry import query

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SPACE = " \t\n\v\f\r"
#: Turns from which parities are folded.
LONG = 2048
NEVER = 1 << 60
_LAST = "[.!?]"
_ROLES = {"u": "user", "a": "assistant"}
_ORDER = {"su", "ua", "au"}


# --- one conversation.  A letter per turn: the role's initial (x: any other), in capitals if truncated, - if it must go.


def place_cost(letter: str, role: str) -> int:
    """Cost of putting a turn where the target wants ``role``: kept, or given another role; NEVER if it cannot be."""
    if letter == "-":
        return NEVER
    own = letter.lower()
    extra = TRUNCATED if letter != own else 0
    return extra if own == role else (NEVER if role == "s" else extra + REROLE)


def quick_repair(letters: str) -> int:
    """Cost of a valid repair: keep what is next in order, delete all else."""
    cost, kept, odd, want = 0, 0, False, "su"
    for letter in letters:
        if letter in want:
            odd = odd or letter == "s"
            kept += letter != "s"
            want = "a" if letter == "u" else "u"
        else:
            cost += DELETE
    if kept % 2:
        cost, kept = cost + DELETE, kept - 1
    return cost + (DELETE if odd and not kept else 0)


def aligned(letters: str) -> tuple[int, str]:
    """(least cost, its least audit), by one banded table for the targets of all lengths."""
    n = len(letters)
    limit = quick_repair(letters)
    gone = letters.count("-")
    spare = limit - DELETE * gone  # what is left for anything but the deletions no path can avoid
    live = [0] * (n + 1)  # turns from i on that may stay
    for i in range(n - 1, -1, -1):
        live[i] = live[i + 1] + (letters[i] != "-")
    cost = {"u": [place_cost(c, "u") for c in letters], "a": [place_cost(c, "a") for c in letters]}
    # Row i holds columns from base[i] on: the last j initials of a target; the last is a, the one before u, and so on.
    base, rows = [0] * (n + 1), [[]] * (n + 1)
    for i in range(n, -1, -1):
        low, high = max(0, live[i] - spare // DELETE), live[i] + spare // INSERT
        row = []
        if i < n:
            under, shift = rows[i + 1], base[i + 1]
            by = (cost["u"][i], cost["a"][i])
        for j in range(low, high + 1):
            if i == n:
                row.append(INSERT * j)
                continue
            best = under[j - shift] + DELETE if 0 <= j - shift < len(under) else NEVER
            if 0 <= j - 1 - shift < len(under):
                best = min(best, under[j - 1 - shift] + by[j & 1])
            if row:
                best = min(best, row[-1] + INSERT)
            row.append(best)
        base[i], rows[i] = low, row

    def cell(i: int, j: int) -> int:
        at = j - base[i]
        return rows[i][at] if 0 <= at < len(rows[i]) else NEVER

    def trace(i: int, j: int) -> str:
        out = []
        while i < n or j:
            here = cell(i, j)
            if i < n and here == cell(i + 1, j) + DELETE:
                out.append("D")
                i += 1
            elif j and here == cell(i, j - 1) + INSERT:
                out.append("I")
                j -= 1
            else:
                role = "a" if j & 1 else "u"
                out.append("K" if letters[i].lower() == role else "R")
                i, j = i + 1, j - 1
        return "".join(out)

    # Even lengths start in the table, odd ones with a kept system turn after i deletions.
    starts = [(cell(0, j), 0, j, "") for j in range(0, base[0] + len(rows[0]), 2)]
    for i, letter in enumerate(letters):
        kept = place_cost(letter, "s")
        if kept < NEVER:
            for j in range(2, base[i + 1] + len(rows[i + 1]), 2):
                starts.append((DELETE * i + kept + cell(i + 1, j), i + 1, j, "D" * i + "K"))
    least = min(s[0] for s in starts)
    return least, min(before + trace(i, j) for total, i, j, before in starts if total == least)


#: What may follow: state -> (initial, next state).  0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEXT = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}


def folded(letters: str) -> tuple[int, str]:
    """As :func:`aligned`, with the table's columns folded by what may come before them: four numbers a turn."""
    n = len(letters)
    rows = [array("q", bytes(8 * (n + 1))) for _ in range(4)]

    def closed(i: int, row: list[int]) -> None:
        """Allow insertions: at most two in a row are of use."""
        u, a = row[2], row[3]
        row[2], row[3] = min(u, a + INSERT), min(a, u + INSERT)
        row[0], row[1] = min(row[0], row[2] + INSERT), min(row[1], row[2] + INSERT)
        for state in range(4):
            rows[state][i] = row[state]

    closed(n, [0, NEVER, NEVER, 0])
    costs = {c: {r: place_cost(c, r) for r in "sua"} for c in set(letters)}
    for i in range(n - 1, -1, -1):
        here, row = costs[letters[i]], []
        for state in range(4):
            best = rows[state][i + 1] + DELETE
            for role, to in _NEXT[state]:
                best = min(best, here[role] + rows[to][i + 1])
            row.append(best)
        closed(i, row)
    out, i, state = [], 0, 0
    while i < n or rows[state][i]:
        here = rows[state][i]
        if i < n and here == rows[state][i + 1] + DELETE:
            out.append("D")
            i += 1
            continue
        to = _NEXT[state][-1][1]  # a user or assistant turn
        if here == rows[to][i] + INSERT:
            out.append("I")
            state = to
            continue
        for edit, role, to in sorted(("K" if letters[i].lower() == r else "R", r, to) for r, to in _NEXT[state]):
            if here == costs[letters[i]][role] + rows[to][i + 1]:
                out.append(edit)
                i, state = i + 1, to
                break
    return rows[0][0], "".join(out)


@lru_cache(maxsize=1 << 14)
def _short(letters: str) -> tuple[int, str]:
    return aligned(letters)


def cheapest(letters: str) -> tuple[int, str]:
    """(least cost, least audit) of a conversation; short ones repeat and are remembered."""
    if len(letters) >= LONG:
        return folded(letters)
    return _short(letters) if len(letters) <= 32 else aligned(letters)


# --- streams of turns, sorted by conversation


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, turn, initial, blank, truncated, own, copies) in order to a row per conversation."""
    out, now, state = [], None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv, turn, initial, blank, truncated, own, copies in zip(*columns, strict=True):
            if state is None or conv != now:
                if state is not None:
                    out.append((now, *state.result()))
                now, state = conv, _Turns()
            state.add(turn, initial, blank, truncated, own, copies)
        if len(out) >= 256:
            yield _audit_batch(out)
            out = []
    if state is not None:
        out.append((now, *state.result()))
    yield _audit_batch(out)


class _Turns:
    """Counts, letters and hashes of one conversation's turns."""

    def __init__(self):
        self.seen, self.letters = set(), []
        self.first = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, initial, blank, truncated, own, copies):
        for _ in range(copies):
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
            if self.before is not None and self.before + initial not in _ORDER:
                self.illegal += 1
            self.before = initial
            letter = initial if initial in "sua" and initial else "x"
            if blank:
                self.blank, letter = self.blank + 1, "-"
            elif own in self.seen:
                self.duplicate, letter = self.duplicate + 1, "-"
            elif truncated:
                self.truncated, letter = self.truncated + 1, letter.upper()
            self.seen.add(own)
            self.letters.append(letter)

    def result(self):
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = cheapest("".join(self.letters))
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audit_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * (len(_COUNTS) + 2)
    data = [pa.array(columns[0])] + [pa.array(c, pa.int64()) for c in columns[1:-1]] + [pa.array(columns[-1], pa.string())]
    return pa.RecordBatch.from_arrays(data, ["conv", *_COUNTS, "audit"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, audit, turn of the repair or None): for every conversation one None, then what its audit keeps and inserts.

    Reads (conv, audit, role, text, copies) in order, each conversation's audit before its turns.
    """
    conv, audit, at, made, total, tail = None, "", 0, 0, 0, 0

    def role_of(nth: int) -> str:
        """Role of the nth repaired turn, counted from 0, where it is not kept."""
        return _ROLES["ua"[(nth - total % 2) % 2]]

    def inserted() -> Iterator[tuple]:
        nonlocal at, made
        while at < len(audit) and audit[at] == "I":
            yield conv, audit, (role_of(made), "", "I")
            at, made = at + 1, made + 1

    for batch in batches:
        for c, mine, role, text, copies in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if mine is not None:
                conv, audit, at, made = c, mine, 0, 0
                total, tail = len(audit) - audit.count("D"), len(audit.rstrip("I"))
                yield conv, audit, None
                continue
            for _ in range(copies):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit != "D":
                    yield conv, audit, (role if edit == "K" else role_of(made), text, edit)
                    made += 1
                if at == tail:  # no turn is left
                    yield from inserted()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, digest): sha256 of the repaired turns as role:text, joined by newlines."""
    out, conv, digest, count = [], None, None, 0
    for c, _, turn in _edits(batches):
        if turn is None:
            if digest is not None:
                out.append((conv, digest.hexdigest()))
            conv, digest, count = c, hashlib.sha256(), 0
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["conv", "digest"])
                out = []
        else:
            digest.update((("\n" if count else "") + f"{turn[0]}:{turn[1]}").encode("utf-8", "surrogatepass"))
            count += 1
    if digest is not None:
        out.append((conv, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["conv", "digest"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, place, role, text, edit) of the repaired conversations."""
    names = ["conv", "place", "role", "text", "edit"]
    out, place, size = [], 0, 0
    for conv, _, turn in _edits(batches):
        if turn is None:
            place = 0
            continue
        out.append((conv, place, *turn))
        place, size = place + 1, size + len(turn[1])
        if len(out) >= 512 or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)


# --- tables


class Repair:
    """Audits and repaired turns of the conversations of a table.

    A null role or text is one space; a role's initial is its first character.
    Turns are read by ``turn``, nulls first, and at equal numbers by role and a
    hash of the text.  ``copies`` (1 if not given) says how often a row stands
    there; a row of 0 copies is not there, but its conversation has a result.
    A row's first fault counts: blank, duplicate (role and text as in an
    earlier row), truncated (the last character other than white space is not
    one of ``.!?``).  Null conversation ids are one conversation.  Empty tables
    give empty results; no input column but the named ones is read.

    An audit has a letter per edit, in one cell; a task holds about 100 bytes
    for each turn of the longest conversation it meets.
    """

    def __init__(
        self,
        df: DataFrame,
        scratch: Scratch,
        conv_col: str = "conv_id",
        turn_col: str = "turn",
        role_col: str = "role",
        text_col: str = "text",
        copies_col: str | None = None,
    ):
        c = lambda name: F.col(f"`{name}`")
        text = F.coalesce(c(text_col).cast("string"), F.lit(" "))
        self.rows = df.select(
            c(conv_col).alias("conv"),
            c(turn_col).cast("long").alias("turn"),
            F.coalesce(c(role_col).cast("string"), F.lit(" ")).alias("role"),
            text.alias("text"),
            F.unhex(F.md5(text)).alias("own"),
            (c(copies_col).cast("int") if copies_col else F.lit(1)).alias("copies"),
        )
        self.id_field = T.StructField("conv", self.rows.schema["conv"].dataType)
        bare = F.rtrim(F.col("text"), F.lit(SPACE))
        flat = self.rows.select(
            "conv", "turn", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
            (~F.substring(bare, -1, 1).rlike(_LAST)).alias("truncated"),
            F.unhex(F.md5(F.concat(F.col("role"), F.lit(":"), F.hex("own")))).alias("own"), "copies", "role",
            F.col("own").alias("text"),
        )
        flat = flat.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").drop("role", "text")
        kind = T.StructType([self.id_field, *[T.StructField(n, T.LongType()) for n in _COUNTS], T.StructField("audit", T.StringType())])
        #: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), a row per conversation.
        self.audits = scratch.table(flat.mapInArrow(_audits, kind), "audits")

    def _stream(self) -> DataFrame:
        none = lambda kind: F.lit(None).cast(kind)
        heads = self.audits.select(
            "conv", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
            none("binary").alias("own"), F.lit(0).alias("copies"), "audit",
        )
        rows = self.rows.where("copies > 0").select(
            "conv", F.lit(1).alias("kind"), "turn", "role", "text", "own", "copies", none("string").alias("audit")
        )
        both = heads.union(rows).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "own")
        return both.select("conv", "audit", "role", "text", "copies")

    def turns(self) -> DataFrame:
        """(conv, place, role, text, edit): the repaired conversations, a row per turn."""
        fields = [("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("edit", T.StringType())]
        return self._stream().mapInArrow(_turns, T.StructType([self.id_field, *[T.StructField(*f) for f in fields]]))

    def digests(self) -> DataFrame:
        """(conv, digest): sha256 of each repaired conversation's ``role:text`` lines."""
        return self._stream().mapInArrow(_digests, T.StructType([self.id_field, T.StructField("digest", T.StringType())]))


def damaged(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text, copies): about a quarter of the rows hurt, by a hash of conversation and turn.

    Nulls are one space in the hash, in roles and in texts.
    """
    c = lambda name: F.col(f"`{name}`")
    word = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(word(c(conv_col)), F.lit(":"), word(c(turn_col))).cast("binary")) % 20
    whole = df.select(
        c(conv_col).alias("conv_id"), c(turn_col).alias("turn"), word(c(role_col)).alias("role"), word(c(text_col)).alias("text"),
        fate.alias("fate"),
    )
    text: Column = F.when(F.col("fate") <= 1, "").when(F.col("fate") == 2, F.regexp_replace("text", _LAST, ""))
    return whole.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("copies"),
    )


SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, 0 AS n, CAST(i AS BIGINT) AS c FROM range(256) t(i)
  UNION ALL SELECT byte, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE n < 8),
tab AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE n = 8),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT raw.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate FROM raw, tab),
hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fate WHEN 0 THEN CAST([] AS INTEGER[]) WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed),
convs AS (SELECT conv_id, row_number() OVER () AS v FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT v, turn, role, text, row_number() OVER (PARTITION BY v ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    row_number() OVER (PARTITION BY v, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id),
rows_ AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS who,
    lag(left(role, 1)) OVER (PARTITION BY v ORDER BY i) || left(role, 1) AS pair FROM placed),
counts AS (
  SELECT v, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows_ GROUP BY v),
want AS (SELECT * FROM (VALUES ('0', 's', '1'), ('0', 'u', '2'), ('1', 'u', '2'), ('2', 'a', '3'), ('3', 'u', '2')) t(q, role, q2)),
more AS (
  SELECT q, q AS q2, 0 AS cost, '' AS audit FROM (VALUES ('0'), ('1'), ('2'), ('3')) t(q)
  UNION ALL SELECT q, q2, 5, 'I' FROM want WHERE role <> 's'
  UNION ALL SELECT a.q, b.q2, 10, 'II' FROM want a JOIN want b ON a.q2 = b.q WHERE a.role <> 's'),
moves AS (
  SELECT q, who, fault, q AS q2, 2 AS cost, 'D' AS edit FROM (VALUES ('0'), ('1'), ('2'), ('3')) t(q),
    (VALUES ('s'), ('u'), ('a'), ('x')) w(who), (VALUES (''), ('t'), ('b'), ('d')) f(fault)
  UNION ALL SELECT q, who, fault, q2, CASE WHEN who = role THEN 0 ELSE 1 END + CASE fault WHEN 't' THEN 5 ELSE 0 END,
    CASE WHEN who = role THEN 'K' ELSE 'R' END
  FROM want, (VALUES ('s'), ('u'), ('a'), ('x')) w(who), (VALUES (''), ('t')) f(fault) WHERE who = role OR role <> 's'),
dp AS (
  SELECT v, CAST(1 AS BIGINT) AS i, '0' AS q, {'cost': 0, 'audit': ''} AS best FROM convs
  UNION ALL
  SELECT d.v, d.i + 1, m.q2, min({'cost': d.best.cost + e.cost + m.cost, 'audit': d.best.audit || e.audit || m.edit})
  FROM dp d JOIN more e ON e.q = d.q JOIN rows_ r ON r.v = d.v AND r.i = d.i
  JOIN moves m ON m.q = e.q2 AND m.who = r.who AND m.fault = r.fault GROUP BY d.v, d.i + 1, m.q2),
ends AS (
  SELECT c.v, min({'cost': d.best.cost + e.cost, 'audit': d.best.audit || e.audit}) AS best
  FROM convs c LEFT JOIN counts k USING (v) JOIN dp d ON d.v = c.v AND d.i = coalesce(k.n, 0) + 1 JOIN more e ON e.q = d.q
  WHERE e.q2 IN ('0', '3') GROUP BY c.v),
edits AS (SELECT v, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM ends),
spots AS (
  SELECT v, p, audit[p] AS edit, p - length(regexp_replace(audit[:p], '[^I]', '', 'g')) AS i,
    length(regexp_replace(audit[:p], 'D', '', 'g')) AS m, length(regexp_replace(audit, 'D', '', 'g')) % 2 AS odd FROM edits),
fixed AS (
  SELECT s.v, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h
  FROM spots s LEFT JOIN rows_ r ON r.v = s.v AND r.i = s.i WHERE edit <> 'D' GROUP BY s.v)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
  coalesce(h, sha256('')) AS repaired_sha256
FROM convs JOIN ends USING (v) LEFT JOIN counts USING (v) LEFT JOIN fixed USING (v)
"""


@query("op12_conversation_repair", SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired text of every conversation, after damage by rule."""
    hurt = damaged(read(spark, sf_dir, "conversations"))
    repair = Repair(hurt, Scratch(spark, "conversations"), copies_col="copies")
    done = repair.audits.join(repair.digests().withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")))
    return done.select(F.col("conv").alias("conv_id"), *_COUNTS, "audit", F.col("digest").alias("repaired_sha256"))
