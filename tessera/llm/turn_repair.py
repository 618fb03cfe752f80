"""Conversation structure repair by a generalised LR parse over the role grammar.

A well-formed conversation has the role initials ``(s?(ua)+)?``. Reading a
conversation in order, a graph-structured stack keeps one top per parser state
(empty, after system, after user, after assistant); every row lets each top
shift (``K``), rerole and shift (``R``), drop the row (``D``) or insert empty
turns (``I``). Tops of one state merge by the least (cost, audit), so four tops
are alive at most, however ambiguous the conversation is. What all living tops
have in common is their trunk: it is committed, its turns leave the parser and
only the branches above it stay in memory.

Two audits of one cost are never a prefix of each other (the letters of an audit
fix the cost of their rows), so the least audit of a state is also the least
with anything appended; and an audit fixes the roles that its edits give.

Spark marks the duplicates (by the first turn of each role and text), deals the
rows by conversation and sorts them; a task reads them as a stream. A single
conversation is parsed by one task, as its digest is one hash over all its
turns, but never held by it.

Defined cases: null roles and texts are one space; rows of equal turn go by
role, then by the text's SHA-256; a null turn comes first and is no turn for
``gaps``; an empty role is never kept; null ids form one conversation; repeated
rows are duplicates of the first; an empty table gives an empty table; extra
columns are dropped; a text is read whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: State after reading a role initial in a state.
_GOTO = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state and role that a rerole or an insert leads to.
_NEXT = {EMPTY: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_WHITE = " \t\n\x0b\x0c\r"
_COMMIT_ROWS = 32
_DROPPED, _MARK, _ROW = -1, 0, 1
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Parser:
    """The repair of one conversation, fed row by row."""

    def __init__(self):
        self.tops = _inserted({EMPTY: (0, "")})
        self.pending: list[tuple[str, str]] = []
        self.state, self.trunk = EMPTY, []

    def feed(self, role: str, text: str, unwanted: bool, truncated: bool) -> list[tuple[str, str, str]]:
        """Read a row; gives the turns (edit, role, text) that are certain by now."""
        merged: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in self.tops.items():
            _merge(merged, state, cost + DELETE, audit + "D")
            if not unwanted:
                cost += TRUNCATED if truncated else 0
                if goto := _GOTO.get((state, role[:1])):
                    _merge(merged, goto, cost, audit + "K")
                _merge(merged, _NEXT[state][0], cost + REROLE, audit + "R")
        self.tops = _inserted(merged)
        self.pending.append((role, text))
        return self._commit(os.path.commonprefix([a for _, a in self.tops.values()])) if len(self.pending) >= _COMMIT_ROWS else []

    def finish(self) -> tuple[int, str, list[tuple[str, str, str]]]:
        """Cost, audit and the remaining turns of the cheapest whole parse."""
        cost, audit = min(top for state, top in self.tops.items() if state in (EMPTY, ASSISTANT))
        turns = self._commit(audit)
        return cost, "".join(self.trunk), turns

    def _commit(self, edits: str) -> list[tuple[str, str, str]]:
        turns, rows = [], iter(self.pending)
        for edit in edits:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit == "K":
                self.state = _GOTO[self.state, role[0]]
            elif edit != "D":
                self.state, role = _NEXT[self.state]
            if edit != "D":
                turns.append((edit, role, text))
        if edits:
            self.trunk.append(edits)
            self.pending = list(rows)
            self.tops = {s: (c, a[len(edits):]) for s, (c, a) in self.tops.items()}
        return turns


def _merge(tops: dict[int, tuple[int, str]], state: int, cost: int, audit: str) -> None:
    if state not in tops or (cost, audit) < tops[state]:
        tops[state] = (cost, audit)


def _inserted(tops: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """The tops with those that inserted turns lead to (user, then assistant; more never pay)."""
    for states in ((EMPTY, SYSTEM, ASSISTANT), (USER,)):
        for state in states:
            if state in tops:
                cost, audit = tops[state]
                _merge(tops, _NEXT[state][0], cost + INSERT, audit + "I")
    # What follows the empty or the system state can follow an assistant's turn as well, but for a system row,
    # which then goes: a top that costs more than this can't win, nor hold the trunk back.
    if ASSISTANT in tops:
        for state, more in ((EMPTY, DELETE), (SYSTEM, 0)):
            if state in tops and tops[state][0] > tops[ASSISTANT][0] + more:
                del tops[state]
    return tops


class _Conversation:
    """Counts and parse of one conversation's sorted rows."""

    def __init__(self):
        self.parser, self.counts = Parser(), dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.place = self.mark = None
        self.distinct, self.initial = 0, None

    def read(self, turn, role: str, digest: bytes, kind: int, text: str):
        place = (turn, role, digest)
        if kind == _MARK:
            self.mark = place
            return []
        if turn is not None and turn != self.high:
            self.low, self.high, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        said = text.rstrip(_WHITE)
        fault = ("blank" if not said else "duplicate" if place in (self.mark, self.place)
                 else "truncated" if said[-1] not in ".!?" else None)
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and (self.initial, role[:1]) not in _LEGAL:
            self.counts["illegal"] += 1
        self.place, self.initial = place, role[:1]
        return self.parser.feed(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def finish(self):
        self.counts["cost"], audit, turns = self.parser.finish()
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.distinct
        return audit, turns


def _stream(rows: DataFrame) -> DataFrame:
    """The rows of each conversation together and in order, each duplicate behind a mark of its place.

    A duplicate within its own turn follows its twin; for others Spark finds
    the first turn of each role and text. ``dropped`` rows only name their conversation.
    """
    keys = ["conv_id", "role", "digest"]
    alive = rows.filter("NOT dropped").withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    narrow = alive.select(*keys, F.struct("turn").alias("at"))
    first = (narrow.groupBy(*keys).agg(F.min("at").alias("first"), F.max("at").alias("last"))
             .filter(~F.col("first").eqNullSafe(F.col("last"))).select(*[F.col(k).alias(f"{k}_") for k in keys], "first"))
    on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    marks = narrow.join(first, on).filter(~F.col("at").eqNullSafe(F.col("first"))).select(*keys, F.col("at.turn").alias("turn")).distinct()
    order = ["conv_id", "turn", "role", "digest", "kind"]
    both = (alive.select(*order[:4], F.lit(_ROW).alias("kind"), "text")
            .unionByName(marks.select(*order[:4], F.lit(_MARK).alias("kind"), F.lit("").alias("text")))
            .unionByName(rows.filter("dropped").select(
                "conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                F.lit(b"").alias("digest"), F.lit(_DROPPED).alias("kind"), F.lit("").alias("text"))))
    return both.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, conversation, certain turns, audit when it ends) as the rows go by."""
    now, one = None, None
    for batch in batches:
        for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if one is None or conv != now:
                if one is not None:
                    audit, turns = one.finish()
                    yield now, one, turns, audit
                now, one = conv, _Conversation()
            if row[3] != _DROPPED and (turns := one.read(*row)):
                yield now, one, turns, None
    if one is not None:
        audit, turns = one.finish()
        yield now, one, turns, audit


def _clean(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): null roles and texts as one space; ``dropped`` is kept where it is given."""
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[
        F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], dropped.alias("dropped"))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and audit of the repair, digest of the repaired ``role:text`` lines."""
    rows = _clean(conversations)
    out = T.StructType([rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in COUNTS],
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports():
            digest, begun = hashlib.sha256(), False
            for conv, one, turns, audit in _conversations(batches):
                for _, role, text in turns:
                    digest.update(("\n" * begun + role + ":" + text).encode())
                    begun = True
                if audit is not None:
                    yield conv, *one.counts.values(), audit, digest.hexdigest()
                    digest, begun = hashlib.sha256(), False

        yield from _batches(reports(), _schema(out))

    return _stream(rows).mapInArrow(run, out)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, role, text, edit): the turns of the repaired conversations, from 0."""
    rows = _clean(conversations)
    out = T.StructType([rows.schema["conv_id"], T.StructField("nth", T.LongType()),
                        *[T.StructField(c, T.StringType()) for c in ("role", "text", "edit")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def said():
            nth = 0
            for conv, _, turns, audit in _conversations(batches):
                for edit, role, text in turns:
                    yield conv, nth, role, text, edit
                    nth += 1
                nth = nth if audit is None else 0

        yield from _batches(said(), _schema(out))

    return _stream(rows).mapInArrow(run, out)


def _schema(fields: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that their id and turn draw (crc32 of ``conv_id:turn``, modulo 20); 0 marks a row as dropped."""
    rows = _clean(conversations.select("conv_id", "turn", "role", "text"))
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = rows.withColumn("draw", F.crc32(named.cast("binary")) % 20)
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return (rows.withColumn("copy", F.explode(copies))
            .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("draw") == 0).alias("dropped")))


def _best(*tops: str) -> str:
    return f"list_sort(list_filter([{', '.join(tops)}], lambda x: x IS NOT NULL))[1]"


def _move(top: str, cost: str, edit: str, piece: str, where: str = "true") -> str:
    """A stack top (cost, audit, text) after an edit; null where there is none."""
    text = f"{top}.t" if edit == "D" else f"CASE WHEN {top}.t = '' THEN {piece} ELSE {top}.t || chr(10) || {piece} END"
    return f"CASE WHEN {top} IS NOT NULL AND {where} THEN {{'c': {top}.c + {cost}, 'a': {top}.a || '{edit}', 't': {text}}} END"


def _oracle() -> str:
    """The same repair as a recursion over the rows, one column per stack top."""
    keep = lambda top, initial: _move(top, "w", "K", "role || ':' || text", f"NOT gone AND left(role, 1) = '{initial}'")
    turn = lambda top, role: _move(top, "w + 1", "R", f"'{role}:' || text", "NOT gone")
    drop = lambda top: _move(top, "2", "D", "''")
    put = lambda top, role: _move(top, "5", "I", f"'{role}:'")
    user = [x for s in ("s0", "s1", "s3") for x in (keep(s, "u"), turn(s, "user"))]
    return f"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           [4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                                  lambda ch: unicode(ch)::BIGINT),
           lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda q, z: xor(q >> 1, 3988292384 * (q & 1))))) % 20 AS draw
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn CROSS JOIN (VALUES (1), (2)) AS twice(copy) WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
  FROM damaged),
faults AS (
  SELECT *, said = '' AS blank, said <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered),
ready AS (
  SELECT *, blank OR duplicate AS gone, NOT (blank OR duplicate) AND right(said, 1) NOT IN ('.', '!', '?') AS truncated FROM faults),
weighed AS (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS w FROM ready),
ids AS (SELECT DISTINCT conv_id FROM conversations),
stack AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 't': 'user:'}} AS s2, {{'c': 10::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM ids
  UNION ALL
  SELECT conv_id, n, n0, n1, i2, {_best('n3', put('i2', 'assistant'))}
  FROM (SELECT conv_id, n, n0, n1, n3, {_best('n2', put('n0', 'user'), put('n1', 'user'), put('n3', 'user'))} AS i2
        FROM (SELECT stack.conv_id, weighed.n, {drop('s0')} AS n0, {_best(drop('s1'), keep('s0', 's'))} AS n1,
                     {_best(drop('s2'), *user)} AS n2, {_best(drop('s3'), keep('s2', 'a'), turn('s2', 'assistant'))} AS n3
              FROM stack JOIN weighed ON weighed.conv_id IS NOT DISTINCT FROM stack.conv_id AND weighed.n = stack.n + 1))),
last AS (SELECT conv_id, {_best('s0', 's3')} AS top FROM stack QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM weighed GROUP BY conv_id)
SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, top.c AS cost, top.a AS audit, sha256(top.t) AS repaired_sha256
FROM last LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM last.conv_id"""


ORACLE = _oracle()
