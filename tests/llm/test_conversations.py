"""Conversation repair against a search over all edits, a textbook chart over all splits, and rows that are hard to handle."""

import hashlib
import heapq
import random
import re
from itertools import groupby
from zlib import crc32

import pytest

from ledgermatch.llm import conversations as C
from ledgermatch.llm import queries

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired) by trying edits in the order of (cost, audit); rows of (role, text, fault)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, place, out = heapq.heappop(heap)
        if (i, place) in seen:
            continue
        seen.add((i, place))
        if i == len(rows) and place in (0, 3):
            return cost, audit, list(out)
        for r, q in NEXT[place].items():
            if r in NAMES:
                heapq.heappush(heap, (cost + 3, audit + "I", i, q, (*out, (NAMES[r], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, place, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for r, q in NEXT[place].items():
                    if r == role[:1]:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, q, (*out, (role, text))))
                    elif r in NAMES:
                        heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, q, (*out, (NAMES[r], text))))


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        last = re.sub("[ \t-\r]+$", "", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(table):
    """conv_id -> report of the contract, for (conv_id, turn, role, text) rows."""
    convs = {r[0]: [] for r in table}
    for conv, turn, role, text in table:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    got = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        flags = faults([r[1:] for r in rows])
        cost, audit, out = cheapest([(r[1], r[2], f) for r, f in zip(rows, flags)])
        turns = [r[0] for r in rows if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        got[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(flags.count(f) for f in C.FAULTS), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return got


def reported(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_report_equals_search_over_edits(spark, seed, monkeypatch):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Maybe?", "", " \t", None, "One. Two!", "x " * 300 + "."]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(12)]),
             rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts), "x", 7)
            for _ in range(700)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, copies int").repartition(5)
    monkeypatch.setattr(C, "SPAN_ROWS", (3, 1024, 1)[seed])
    want = brute([r[:4] for r in rows])
    assert reported(C.report(C.damaged(df), copies="copies")) == want
    assert sum(len(v[6]) > 8 for v in want.values()) > 20


def test_query_equals_search_on_given_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert reported(queries.QUERIES["op13_conversations"](spark, sf)) == brute(rows)


def all_splits(cells):
    """Textbook chart: every span, every split."""
    n = len(cells)
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            out = {}
            for k in range(i + 1, i + length):
                for key, v in C.combine(chart[i, k], chart[k, i + length]).items():
                    out[key] = min(out.get(key, v), v)
            chart[i, i + length] = out
    return chart[0, n]


def test_one_split_per_span_is_enough():
    rng = random.Random(8)
    for _ in range(150):
        rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(1, 14))]
        cells = [C.row_cell(*r) for r in rows]
        assert C.parse(cells) == all_splits(cells)
        cost, audit, _ = cheapest([(i, "t", f) for i, f in rows])
        assert C.repair_of(C.parse(cells)) == (cost, audit)


def test_one_long_conversation(spark):
    """A conversation over many partitions and spans, beside short ones."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {rng.randint(0, 2500)}{rng.choice(['.', ''])}") for t in range(5000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"say {t}.") for c in range(2, 200) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert reported(C.report(C.damaged(df), copies="copies")) == brute(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = C._spans(C._prepared(df, None)).where("conv_id = 1").select("part").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1  # not one task


def test_repaired_rows(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "user", "Again."), ("a", 2, "assistant", "Yes."), ("b", 0, "assistant", ""),
            ("c", 0, "system", "Be kind."), ("c", 1, "user", "Hello?")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = [tuple(r) for r in C.repaired(df).orderBy("conv_id", "at").collect()]
    assert {k: [r[2:] for r in g] for k, g in groupby(got, key=lambda r: r[0])} == {
        "a": [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Again."), ("K", "assistant", "Yes.")],
        "c": [("K", "system", "Be kind."), ("K", "user", "Hello?"), ("I", "assistant", "")]}
    report = reported(C.report(df))
    assert report["b"][1:7] == (1, 0, 0, 0, 4, "D") and report["b"][7] == hashlib.sha256(b"").hexdigest()


def test_conversations_on_hard_rows(spark):
    schema = "conv_id long, turn string, role string, text string, part string, span string"
    empty = spark.createDataFrame([], schema)
    assert C.report(empty).count() == C.report(C.damaged(empty), copies="copies").count() == C.repaired(empty).count() == 0
    hard = spark.createDataFrame([(None, None, None, None, "x", "y"), (1, "one", "user", "A.", None, None),
                                  (1, "2", "assistant", "B.", None, None), (2, None, "user", "word " * 100_000, "x", None)], schema)
    got = reported(C.report(hard))
    assert got[None][:7] == (0, 1, 0, 0, 0, 4, "D")
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KK")  # a turn that is no number comes first
    assert got[2][:7] == (0, 0, 0, 1, 0, 4, "D")
