"""Benchmark decontamination with training suffix arrays.

Every slice of documents that a task holds is one shard: its words become
numbers, and a suffix array orders the suffixes that can begin a match.  Every
test suffix is then looked up in the shard by binary search, which gives all
the places where it occurs; from these the hit words, the items, and the
longest verbatim matches with their locations follow.

* Words are ``[0-9a-z]`` and everything beyond ASCII, after lower-casing A-Z.
* A test suffix counts from ``window`` words on; an item of fewer words (but
  not none) counts as a whole.  Only the first ``window`` words of a test
  suffix are searched: the matches found are then extended word by word.
* A word that no test item has ends every match, so suffixes with fewer known
  words than the shortest test window are left out of the array.
* Nothing is shuffled: documents stay in their partitions.  The test side is
  shipped to the tasks in blocks of at most ``block_chars`` characters (a
  longer item is a block of its own); a larger test set takes more passes over
  the rows, each adding to the findings of the one before.

Null texts have no words.  Repeated rows are judged alike; an item without an
id is named ``null``.  Further columns of the input pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of

WINDOW = 10
BLOCK_CHARS = 8 << 20

#: Bytes of words stay, A-Z become a-z, the rest becomes a blank.
_WORD_BYTES = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
                    for c in range(256))

MATCH_TYPE = "array<struct<item_id:string,item_start:long,doc_start:long,n_words:long>>"
FOUND = f"n_words long, n_hit long, items array<string>, matches {MATCH_TYPE}"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class TestSet:
    """The test windows of a block of items, sorted for look-up."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, text in items:
            if words := tuple(words_of(text)):
                texts.setdefault(words, set()).add(item_id)
        order = sorted(texts)
        self.ids = [sorted(texts[w]) for w in order]  # equal items are one
        self.vocab: dict[bytes, int] = {}
        self.items = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], dtype=np.int32)
                      for words in order]
        self.window = window
        bits = (len(self.vocab) + 1).bit_length()
        self.bits, self.per_key = bits, 62 // bits
        self.n_keys = -(-window // self.per_key)
        # places[length][window] = [(item, start), ...]
        places: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for i, ids in enumerate(self.items):
            length = min(window, len(ids))
            for s in range(len(ids) - length + 1):
                places.setdefault(length, {}).setdefault(ids[s:s + length].tobytes(), []).append((i, s))
        self.lengths = sorted(places)
        self.least = self.lengths[0] if places else 0
        self.windows = {n: (np.array([np.frombuffer(k, dtype=np.int32) for k in w]).reshape(len(w), n),
                            list(w.values())) for n, w in places.items()}

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """Sortable byte keys of word rows (of ``window`` words, zero-padded)."""
        out = np.zeros((len(rows), self.n_keys), dtype=">u8")
        for j in range(self.n_keys):
            key = np.zeros(len(rows), dtype=np.uint64)
            for i in range(self.per_key):
                key <<= np.uint64(self.bits)
                if (c := j * self.per_key + i) < self.window:
                    key |= rows[:, c].astype(np.uint64)
            out[:, j] = key
        return out.view(f"S{8 * self.n_keys}").ravel()


def find(texts: list[str | None], tests: TestSet) -> list[tuple[int, np.ndarray, list[str], list[dict]]]:
    """For each text of a shard: number of words, hit words as a boolean array, items, longest matches."""
    lengths, parts, get = [], [], tests.vocab.get
    for t in texts:
        words = words_of(t)
        lengths.append(len(words))
        parts.append(np.array([get(w, 0) for w in words] + [0], dtype=np.int32))
    ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    found: list[tuple[set[int], list]] = [(set(), []) for _ in texts]
    if tests.least and len(ids):
        for n, at, which in _occurrences(ids, tests):
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
            doc = np.searchsorted(starts, at, side="right") - 1
            _, places = tests.windows[n]
            for d, w in np.unique(np.stack([doc, which]), axis=1).T.tolist():
                found[d][0].update(i for i, _ in places[w])
            _longest(ids, starts, n, at, which, doc, tests, found)
    hit = np.cumsum(cover[:-1]) > 0
    out = []
    for d, n in enumerate(lengths):
        names = sorted({x for i in found[d][0] for x in tests.ids[i]})
        matches = [{"item_id": tests.ids[i][0], "item_start": s, "doc_start": p, "n_words": length}
                   for p, i, s, length in sorted(set(found[d][1]))]
        out.append((n, hit[starts[d]:starts[d] + n], names, matches))
    return out


def _occurrences(ids: np.ndarray, tests: TestSet):
    """(window length, places in ids, index of the window) by binary search in the shard's suffix array."""
    ends = np.flatnonzero(ids == 0)  # every text ends with a zero
    known = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(len(ids))
    suffixes = np.flatnonzero(known >= tests.least)
    if not len(suffixes):
        return
    # words past the end of the known ones count as zero, the smallest
    columns = np.arange(tests.window)
    rows = ids[np.minimum(suffixes[:, None] + columns, len(ids) - 1)]
    rows[columns >= known[suffixes][:, None]] = 0
    keys = tests.keys(rows)
    order = np.argsort(keys, kind="stable")
    keys, suffixes = keys[order], suffixes[order]
    for n in tests.lengths:
        grams, _ = tests.windows[n]
        low, high = np.zeros((len(grams), tests.window), np.int64), np.full((len(grams), tests.window), (1 << tests.bits) - 1)
        low[:, :n] = high[:, :n] = grams
        lo, hi = np.searchsorted(keys, tests.keys(low), "left"), np.searchsorted(keys, tests.keys(high), "right")
        which = np.repeat(np.arange(len(grams)), hi - lo)
        if len(which):
            at = suffixes[np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange(len(which))]
            by_place = np.argsort(at, kind="stable")
            yield n, at[by_place], which[by_place]


def _longest(ids, starts, n, at, which, doc, tests, found) -> None:
    """Covers each stretch of hit places with longest matches."""
    _, places = tests.windows[n]
    i = 0
    while i < len(at):
        p, d = int(at[i]), int(doc[i])
        best = None
        for item, s in places[int(which[i])]:
            test = tests.items[item]
            back = 0  # the match may begin before the first place that is not yet covered
            while s - back > 0 and p - back > starts[d] and test[s - back - 1] == ids[p - back - 1]:
                back += 1
            rest = min(len(test) - s, len(ids) - p)
            same = test[s:s + rest] == ids[p:p + rest]
            length = rest if same.all() else int(np.argmin(same))
            if best is None or length > best[0]:
                best = (length, p - back - int(starts[d]), item, s - back, length + back)
        found[d][1].append(best[1:])
        # the next window that this match does not hold
        i = int(np.searchsorted(at, p + best[0] - n + 1, "left")) if best[0] >= n else i + 1
        i = max(i, int(np.searchsorted(at, p, "right")))


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                            text_of().alias("text"))


def test_blocks(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[TestSet]:
    """The test set in blocks of bounded size."""
    items = _items(benchmark).where(F.length("text") > 0)
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * chars // block_chars)) if chars > block_chars else 1
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b)
        yield TestSet([(r.item_id, r.text) for r in part.collect()], window)


test_blocks.__test__ = False


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_words, n_hit, items, matches`` per document.

    ``matches`` lists longest verbatim matches as item, start in the item,
    start in the document and length, all in words; of equal items the
    smallest id is named, ``items`` has them all.
    """
    blocks = list(test_blocks(benchmark, window, block_chars))
    rows = docs.select("doc_id", text_of().alias("text"))
    spans = "array<struct<start:long,stop:long>>"
    schema = f"{rows.schema['doc_id'].simpleString()}, text string"
    for k, tests in enumerate(blocks):
        last = k + 1 == len(blocks)
        out = f"{schema}, __n long, __spans {spans}, __items array<string>, __matches {MATCH_TYPE}"
        rows = rows.mapInArrow(_pass(tests, k > 0, not last), out)
    return rows.select("doc_id", F.col("__n").alias("n_words"),
                       F.coalesce(F.aggregate("__spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]),
                                  F.lit(0)).alias("n_hit"),
                       F.array_sort("__items").alias("items"), F.col("__matches").alias("matches"))


def _pass(tests: TestSet, again: bool, keep_text: bool):
    """One pass over documents with one block of tests; adds to what earlier passes found."""
    match_arrow = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                                      ("doc_start", pa.int64()), ("n_words", pa.int64())]))
    span_arrow = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [x for lo, hi in slices(texts) for x in find(texts[lo:hi], tests)]
            old = b.to_pylist() if again else None
            spans, items, longest = [], [], []
            for d, (n, hit, names, found_matches) in enumerate(found):
                if again:
                    hit = hit.copy()
                    for s in old[d]["__spans"]:
                        hit[s["start"]:s["stop"]] = True
                    names = sorted({*names, *old[d]["__items"]})
                    found_matches = old[d]["__matches"] + found_matches
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                spans.append([{"start": int(s), "stop": int(e)} for s, e in zip(edges[::2], edges[1::2])])
                items.append(names)
                longest.append(found_matches)
            kept = b.column(1) if keep_text else pa.array([""] * len(texts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), kept, pa.array([n for n, *_ in found], pa.int64()), pa.array(spans, span_arrow),
                 pa.array(items, pa.list_(pa.string())), pa.array(longest, match_arrow)],
                ["doc_id", "text", "__n", "__spans", "__items", "__matches"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text holds no test window, all columns as they are."""
    text_at = docs.columns.index("text")
    for tests in test_blocks(benchmark, window, block_chars):

        def run(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = b.column(text_at).to_pylist()
                keep = [not hit.any() for lo, hi in slices(texts) for _, hit, _, _ in find(texts[lo:hi], tests)]
                yield b.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


# DuckDB SQL of the registered query
ORACLE = r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM documents, low),
b AS MATERIALIZED (SELECT coalesce(item_id::VARCHAR, 'null') AS item_id,
  regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM benchmark, low),
i AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
t AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM i)),
g AS (SELECT rid, n, s, array_to_string(ws[s:s + n - 1], ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM t) WHERE len(ws) >= n)),
m AS MATERIALIZED (SELECT DISTINCT rid, g.n, s, item_id FROM g JOIN t USING (n, win)),
hit AS (SELECT rid, count(DISTINCT w) AS n FROM (SELECT DISTINCT rid, unnest(range(s, s + n)) AS w FROM m) GROUP BY rid),
it AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM m GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
