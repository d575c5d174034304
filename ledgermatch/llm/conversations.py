"""Conversation structure repair by weighted CYK parsing over intervals of rows.

A conversation's role initials should read ``(s?(ua)+)?``: perhaps a system
row, then user and assistant in turn, or nothing.  The repair grammar is in
Chomsky normal form.  A nonterminal ``pq`` derives rows that lead from place p
of that pattern to place q:

    pq -> pr rq             two neighbouring spans
    pq -> one row, edited   K keep (0), R rerole to user or assistant (3),
                            D delete (4); an undeleted truncated row adds 3;
                            blank and duplicate rows must go
    pq -> inserted rows     I (3 each), closed over before and after each row

A chart cell holds, per nonterminal, the least ``(cost, audit)``, the audit
being the edits' initials in order.  Cells are combined bottom-up by span
length.  Two facts keep the chart small and exact:

* Any split of a span derives the same edits (``pq`` is a path, and a path may
  be cut anywhere), so one split per span is enough and the chart holds spans
  of 1, 2, 4, ... rows rather than all of them.
* Audits of one cost in a cell are never prefixes of each other (one would have
  more insertions and so a higher cost), so the least audit of two
  neighbouring spans is the least audits put together.

Plan: faults are found by aggregates over hashes of the texts; rows without
their texts are ordered by a range shuffle, so a conversation of any size is
dealt over many tasks; every task parses its stretch of each conversation into
one span.  Then the spans and the rows with their texts meet per conversation
in sorted order: a task joins the spans, which gives the audit, and streams the
rows past it.  Nothing but spans and audits is held in memory.  Only the
SHA-256 of a conversation, a chain over all its text by definition, makes one
task read one conversation's rows, as a stream.

Null role, text and ids count as one space in keys and texts; a null turn comes
first.  A null conversation is one of its own.  Ties of a turn are ordered by
role, the first 32 characters and then the hash of the text.  Repeated rows are
duplicates.  Turns that are no numbers count as null.  Further columns are
ignored.  An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: place of the pattern -> {initial: next place}; places 0 and 3 may end a conversation.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
#: Rows parsed into one span before the next is begun.
SPAN_ROWS = 1024

#: A cell: nonterminal -> (cost, audit).
Cell = dict[tuple[int, int], tuple[int, str]]


# -- the grammar ------------------------------------------------------------------------------
def _insertions() -> Cell:
    """Cheapest way to get from place to place by inserted rows only."""
    cell = {(p, p): (0, "") for p in STEPS}
    for p in STEPS:
        at, cost, audit = p, 0, ""
        for _ in range(2):
            nxt = {r: q for r, q in STEPS[at].items() if r in ROLES}
            if not nxt:
                break
            at, cost, audit = next(iter(nxt.values())), cost + INSERT, audit + "I"
            cell.setdefault((p, at), (cost, audit))
    return cell


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts: pq -> pr rq, least (cost, audit) of each."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in range(4):
            if (other := right.get((r, q))) is not None:
                cost = c1 + other[0]
                best = out.get((p, q))
                if best is None or cost < best[0] or (cost == best[0] and a1 + other[1] < best[1]):
                    out[p, q] = (cost, a1 + other[1])
    return out


INSERTED = _insertions()


@lru_cache(maxsize=None)
def row_cell(initial: str, fault: str) -> Cell:
    """The cell of one row, with insertions before and after it."""
    edits: Cell = {(p, p): (DELETE, "D") for p in STEPS}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        for p, steps in STEPS.items():
            for role, q in steps.items():
                if role == initial:
                    edits[p, q] = (KEEP + more, "K")
                elif role in ROLES:
                    edits[p, q] = (REROLE + more, "R")
    return combine(combine(INSERTED, edits), INSERTED)


def parse(cells: list[Cell]) -> Cell:
    """The cell of the whole span: spans of 1, 2, 4, ... rows, bottom-up."""
    if not cells:
        return INSERTED
    while len(cells) > 1:
        pairs = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0]


def repair_of(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in ENDS if (0, q) in cell)


# -- spans of a conversation ------------------------------------------------------------------
class Span:
    """A stretch of a conversation: its cell and what the report counts, joined with a later stretch by ``then``."""

    def __init__(self, cell=None, counts=(0, 0, 0, 0), first=None, last=None, turns=None):
        self.cell, self.counts, self.first, self.last, self.turns = cell, counts, first, last, turns

    def then(self, other: "Span") -> "Span":
        if other.cell is None:
            return self
        if self.cell is None:
            return other
        counts = [a + b for a, b in zip(self.counts, other.counts)]
        counts[3] += (self.last + other.first) not in LEGAL
        turns = self.turns or other.turns
        if self.turns and other.turns:  # least, most, how many
            (lo, hi, n), (lo2, hi2, n2) = self.turns, other.turns
            turns = (lo, hi2, n + n2 - (hi == lo2))
        return Span(combine(self.cell, other.cell), tuple(counts), self.first, other.last, turns)

    def packed(self) -> str:
        cell = None if self.cell is None else [[p, q, c, a] for (p, q), (c, a) in self.cell.items()]
        return json.dumps([cell, self.counts, self.first, self.last, self.turns])

    @staticmethod
    def unpacked(text: str) -> "Span":
        cell, counts, first, last, turns = json.loads(text)
        return Span(None if cell is None else {(p, q): (c, a) for p, q, c, a in cell}, tuple(counts), first, last,
                    turns and tuple(turns))

    @property
    def gaps(self) -> int:
        return min(self.turns[1] - self.turns[0] + 1 - self.turns[2], 2 ** 63 - 1) if self.turns else 0


FAULTS = ("blank", "duplicate", "truncated")


def span_of(rows: list[tuple[int | None, str, str]]) -> Span:
    """``rows`` in order: turn, role initial, fault or ''."""
    counts = [sum(f == fault for _, _, f in rows) for fault in FAULTS]
    counts.append(sum(a[1] + b[1] not in LEGAL for a, b in zip(rows, rows[1:])))
    turns = [t for t, _, _ in rows if t is not None]
    return Span(parse([row_cell(i, f) for _, i, f in rows]), tuple(counts), rows[0][1], rows[-1][1],
                (turns[0], turns[-1], len(set(turns))) if turns else None)


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition to spans: conv_id, part (partition and number), span."""
    part, number = TaskContext.get().partitionId(), 0
    conv, rows, started, out = None, [], False, []

    def flush():
        nonlocal rows, number
        out.append((conv, part, number, (span_of(rows) if rows else Span()).packed()))
        rows, number = [], number + 1

    kind = None
    for b in batches:
        kind = b.schema.field(0).type
        for c, turn, role, blank, cut, copies, first in zip(*[x.to_pylist() for x in b.columns]):
            if not started or c != conv:
                if started:
                    flush()
                conv, started = c, True
            for k in range(copies):
                fault = "blank" if blank else "duplicate" if k or not first else "truncated" if cut else ""
                rows.append((turn, role[:1], fault))
                if len(rows) >= SPAN_ROWS:
                    flush()
        if len(out) >= 4096:
            yield _spans_batch(out, kind)
            out = []
    if started:
        flush()
    if out:
        yield _spans_batch(out, kind)


def _spans_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, part, number, span = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, kind), pa.array(part, pa.int32()), pa.array(number, pa.int32()),
                                       pa.array(span, pa.string())], ["conv_id", "part", "number", "span"])


# -- replay: audits applied to rows -----------------------------------------------------------
class _Replay:
    """One conversation while its rows stream past: ``row`` and ``end`` yield repaired rows (edit, role, text)."""

    def __init__(self, conv):
        self.conv, self.span, self.at, self.place, self.cost, self.audit = conv, Span(), 0, 0, 0, None

    def _ready(self):
        if self.audit is None:
            self.cost, self.audit = repair_of(self.span.cell or INSERTED)

    def _put(self, role: str):
        self.place = STEPS[self.place][role]

    def _inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role = next(r for r in STEPS[self.place] if r in ROLES)
            self._put(role)
            yield "I", ROLES[role], ""

    def row(self, role: str, text: str):
        self._ready()
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[:1])
            yield "K", role, text
        elif edit == "R":
            new = next(r for r in STEPS[self.place] if r in ROLES and r != role[:1])
            self._put(new)
            yield "R", ROLES[new], text

    def end(self):
        self._ready()
        yield from self._inserted()


def _replayed(batches: Iterator[pa.RecordBatch]):
    """(conversation, None at its start, a repaired row or, at its end, the conversation itself) in order."""
    now, started = None, False
    for b in batches:
        for conv, span, role, text, copies in zip(*[b.column(c).to_pylist() for c in ("conv_id", "span", "role", "text", "copies")]):
            if not started or conv != now.conv:
                if started:
                    for r in now.end():
                        yield now, r
                    yield now, None
                now, started = _Replay(conv), True
            if span is not None:
                now.span = now.span.then(Span.unpacked(span))
            else:
                for _ in range(copies):
                    for r in now.row(role, text):
                        yield now, r
    if started:
        for r in now.end():
            yield now, r
        yield now, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


REPORT = [("gaps", pa.int64()), *[(c, pa.int64()) for c in (*FAULTS, "illegal", "cost")], ("audit", pa.string()),
          ("repaired_sha256", pa.string())]
ROWS = [("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind: list[pa.DataType] = []

    def seen(bs):
        for b in bs:
            kind[:] = [b.schema.field("conv_id").type]
            yield b

    def rows():
        digest, first = hashlib.sha256(), True
        for now, r in _replayed(seen(batches)):
            if r is not None:
                digest.update(f"{'' if first else chr(10)}{r[1]}:{r[2]}".encode())
                first = False
            else:
                yield (now.conv, now.span.gaps, *now.span.counts, now.cost, now.audit, digest.hexdigest())
                digest, first = hashlib.sha256(), True

    held = iter(rows())
    head = next(held, None)
    if head is not None:
        schema = pa.schema([("conv_id", kind[0]), *REPORT])
        yield from _batches(_chain(head, held), schema)


def _row_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind: list[pa.DataType] = []

    def seen(bs):
        for b in bs:
            kind[:] = [b.schema.field("conv_id").type]
            yield b

    def rows():
        at = 0
        for now, r in _replayed(seen(batches)):
            if r is not None:
                yield (now.conv, at, *r)
                at += 1
            else:
                at = 0

    held = iter(rows())
    head = next(held, None)
    if head is not None:
        yield from _batches(_chain(head, held), pa.schema([("conv_id", kind[0]), *ROWS]))


def _chain(head, rest):
    yield head
    yield from rest


# -- DataFrames -------------------------------------------------------------------------------
def _prepared(rows: DataFrame, copies: str | None) -> DataFrame:
    """conv_id, turn, role, text, copies without nulls but in the id and the turn, with what orders and judges a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    n = F.lit(1) if copies is None else F.col(copies)
    out = rows.select("conv_id", F.expr("try_cast(turn AS bigint)").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                      n.cast("int").alias("copies"))
    return out.withColumns({
        "head": F.substring("text", 1, 32), "h": F.md5(F.col("text").cast("binary")),
        "blank": ~F.col("text").rlike(r"[^ \t-\r]"),
        "cut": ~F.col("text").rlike(r"[.!?][ \t-\r]*\z")})


ORDER = ["turn", "role", "head", "h"]


def _spans(rows: DataFrame) -> DataFrame:
    """``conv_id, part, number, span`` of prepared rows; the parts of a conversation follow each other."""
    keys = ["conv_id", "role", "head", "h", "blank", "cut"]
    light = rows.select(*keys, "turn", "copies", F.lit(False).alias("first"))
    firsts = (light.where(~F.col("blank") & (F.col("copies") > 0)).groupBy(*keys)
              .agg(F.bool_or(F.col("turn").isNull()).alias("early"), F.min("turn").alias("turn")))
    firsts = firsts.select(*keys, F.when(~F.col("early"), F.col("turn")).alias("turn"), F.lit(0).alias("copies"),
                           F.lit(True).alias("first"))
    flagged = (light.unionByName(firsts).groupBy(*keys, "turn")
               .agg(F.sum("copies").alias("copies"), F.bool_or("first").alias("first")))
    # The order of a conversation is part of the range, so a large one spans many partitions.
    ordered = flagged.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return (ordered.select("conv_id", "turn", "role", "blank", "cut", "copies", "first")
            .mapInArrow(_span_rows, f"conv_id {kind}, part int, number int, span string"))


def _replay(rows: DataFrame, copies: str | None, function, schema: str) -> DataFrame:
    ready = _prepared(rows, copies)
    spans = _spans(ready)
    nothing = F.lit(None)
    both = spans.select("conv_id", "part", "number", *[nothing.cast(t).alias(c) for c, t in (
        ("turn", "bigint"), ("role", "string"), ("head", "string"), ("h", "string"), ("text", "string"))],
        F.lit(0).alias("copies"), "span")
    both = both.unionByName(ready.where(F.col("copies") > 0).select(
        "conv_id", F.lit(2 ** 31 - 1).alias("part"), F.lit(0).alias("number"), *ORDER, "text", "copies",
        nothing.cast("string").alias("span")))
    sorted_rows = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number", *ORDER)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return sorted_rows.select("conv_id", "span", "role", "text", "copies").mapInArrow(function, f"conv_id {kind}, {schema}")


def report(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost and audit of the repair, SHA-256 of its rows.

    ``copies`` names a column with the number of times a row counts; without it
    once.  A conversation whose rows all count 0 has no rows.
    """
    counts = ", ".join(f"{c} long" for c in ("gaps", *FAULTS, "illegal", "cost"))
    return _replay(rows, copies, _reports, f"{counts}, audit string, repaired_sha256 string")


def repaired(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, at`` (place, from zero), ``edit`` (K, R or I), ``role, text``."""
    return _replay(rows, copies, _row_lists, "at long, edit string, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows dropped, emptied, cut, repeated or given the user's role by a hash."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text")))
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
                                text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


# DuckDB SQL of ``report(damaged(conversations))``: places one row after the other, the least (cost, audit) of each
_INF = "{'c': 1000000000, 'a': 'Z'}"


def _more(cell: str, cost: str, edit: str) -> str:
    return f"{{'c': {cell}.c + {cost}, 'a': {cell}.a || '{edit}'}}"


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


def _closed(x: list[str]) -> list[str]:
    i, ii = (lambda c: _more(c, "3", "I")), (lambda c: _more(c, "6", "II"))
    return [x[0], x[1], _least(x[2], i(x[0]), i(x[1]), i(x[3])), _least(x[3], i(x[2]), ii(x[0]), ii(x[1]))]


def _row_step() -> list[str]:
    may = "d.fault IN (1, 2)"
    cut = "CASE WHEN d.fault = 3 THEN 3 ELSE 0 END"

    def use(place: int, role: str, rerole: bool) -> str:
        other = f"WHEN NOT ({may}) THEN {_more(f's.x{place}', f'3 + {cut}', 'R')}" if rerole else ""
        return f"CASE WHEN NOT ({may}) AND d.ri = '{role}' THEN {_more(f's.x{place}', cut, 'K')} {other} ELSE {_INF} END"

    gone = [_more(f"s.x{p}", "4", "D") for p in range(4)]
    return [gone[0], _least(gone[1], use(0, "s", False)),
            _least(gone[2], use(0, "u", True), use(1, "u", True), use(3, "u", True)), _least(gone[3], use(2, "a", True))]


ORACLE = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i::UINTEGER], list_transform(range(8), lambda k: 0::UINTEGER)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END)) AS t),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS key FROM conversations),
hashed AS (SELECT raw.*, xor(list_reduce(list_concat([4294967295::UINTEGER],
    list_transform(range(octet_length(key)), lambda i: ('0x' || hex(key)[2 * i + 1 : 2 * i + 2])::UINTEGER)),
    lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::UINTEGER) % 20 AS kind FROM raw, crc),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dam),
flt AS MATERIALIZED (SELECT *, left(role, 1) AS ri, CASE WHEN NOT regexp_matches(text, '[^ \t-\r]') THEN 1
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
  WHEN NOT regexp_matches(text, '[.!?][ \t-\r]*$') THEN 3 ELSE 0 END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
convs AS (SELECT DISTINCT conv_id FROM conversations),
st(conv_id, i, x0, x1, x2, x3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, {_INF}, {{'c': 3, 'a': 'I'}}, {{'c': 6, 'a': 'II'}} FROM convs
  UNION ALL
  SELECT conv_id, i, {', '.join(_closed([f"y{p}" for p in range(4)]))} FROM (
    SELECT s.conv_id, d.i, {', '.join(f"{e} AS y{p}" for p, e in enumerate(_row_step()))}
    FROM st s JOIN flt d ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.i = s.i + 1)),
done AS (SELECT conv_id, i AS n, {_least('x0', 'x3')} AS best FROM st
         QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
ops AS (SELECT conv_id, k, best.a[k] AS op, length(replace(best.a[:k], 'I', '')) AS i
        FROM (SELECT *, unnest(range(1, length(best.a) + 1)) AS k FROM done)),
outs AS (SELECT o.conv_id, o.k, o.op, d.role, d.text, d.ri, row_number() OVER (PARTITION BY o.conv_id ORDER BY k) AS o
         FROM ops o LEFT JOIN flt d ON d.conv_id IS NOT DISTINCT FROM o.conv_id AND d.i = o.i AND o.op <> 'I'
         WHERE o.op <> 'D'),
lined AS (SELECT conv_id, k, CASE WHEN op = 'K' THEN role
    WHEN (o - max(CASE WHEN op = 'K' AND ri = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1
    THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE text END AS line FROM outs),
shas AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS sha FROM lined GROUP BY conv_id),
cnt AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1) AS blank,
  count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
  count_if(i > 1 AND before || ri NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY conv_id)
SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM done LEFT JOIN shas ON shas.conv_id IS NOT DISTINCT FROM done.conv_id
LEFT JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM done.conv_id
"""
