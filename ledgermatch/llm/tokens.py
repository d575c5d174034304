"""Edit-aware token counts: a segment tree of pre-tokens per document.

Byte-pair merges never cross a pre-token, so a text's count is the sum over its
pre-tokens.  ``counted`` cuts each text into leaves of ``LEAF`` pre-tokens and
keeps a binary tree of their characters and tokens.  ``edited`` applies edits:
it descends to a leaf that begins ``CONTEXT`` characters or more before the
edit, which is as far as a pre-token may have looked ahead, re-encodes until a
new boundary falls on an old leaf's boundary behind the edit, and renews the
sums on the way up.  A leaf that has outgrown ``2 * LEAF`` pre-tokens becomes a
subtree of new ones; a tree that has grown too deep, or whose leaves are mostly
empty, is laid out anew from its leaves' sums.  The rest of the text is neither
copied nor looked at again, and the result is exact.

The vocabulary is read on the driver from ``vocabulary`` and broadcast; its size
is that of one vocabulary file.  A missing file fails there, with its path.

``edits`` is an array of (start, end, replacement) in code points of the text;
null means none, and a column of another type is refused.  They count from the
unedited text, by start; places outside the text are moved to its ends, and an
edit that begins inside the one before begins behind it.  A null start or end
counts as 0, a null replacement as empty, a null edit as none.  Null texts count
as empty.  Repeated rows are kept; further columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern that belongs to the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters beyond its end that the pattern may look at for a pre-token, at most.
CONTEXT = 4
LEAF = 32
CACHED_PIECES = 200_000

TREE = "array<int>"
STATE = f"pieces array<string>, chars {TREE}, tokens {TREE}"
EDITS = "array<struct<start:int,end:int,replacement:string>>"
Leaf = tuple[str, int, int]  # text, characters, tokens


def ranks_of(vocabulary: str = VOCABULARY) -> dict[bytes, int]:
    """The byte pieces of a vocabulary file and their ranks."""
    if not os.path.exists(vocabulary):
        raise FileNotFoundError(f"no vocabulary file at {vocabulary}: give its path as `vocabulary`")
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Known(dict):
    """Token counts of pre-tokens, encoded when first asked for; up to ``CACHED_PIECES`` short ones are kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = n
        return n


class Counter:
    """Cuts texts into pre-tokens and counts their tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        # one pre-token is one piece here: the splitting has been done
        encoder = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.count = Known(encoder.encode_ordinary).__getitem__

    def total(self, text: str) -> int:
        return sum(map(self.count, self.pattern.findall(text)))

    def leaf(self, pieces: list[str]) -> Leaf:
        text = "".join(pieces)
        return text, len(text), sum(map(self.count, pieces))

    def leaves(self, text: str) -> list[Leaf]:
        return self.cut(self.pattern.findall(text))

    def cut(self, pieces: list[str]) -> list[Leaf]:
        return [self.leaf(pieces[k:k + LEAF]) for k in range(0, len(pieces), LEAF)]


def build(leaves: list[int]) -> list[int]:
    """A tree in an array of 2 * width: node i sums 2i and 2i + 1, the leaves begin at width."""
    width = 1 << max(0, len(leaves) - 1).bit_length()
    tree = np.zeros(2 * width, dtype=np.int64)
    tree[width:width + len(leaves)] = leaves
    low = width
    while low > 1:
        tree[low // 2:low] = tree[low:2 * low].reshape(-1, 2).sum(axis=1)
        low //= 2
    return tree.tolist()


class Document:
    """A text in leaves under a binary tree: node 1 is the root, a node without children is a leaf."""

    def __init__(self, pieces: list[str], chars: list[int], tokens: list[int]):
        self.encoded = 0  # characters that edits had encoded anew
        self._lay(pieces, chars, tokens)

    @classmethod
    def of(cls, leaves: list[Leaf]) -> Document:
        return cls(*trees(leaves))

    def _lay(self, pieces: list[str], chars: list[int], tokens: list[int]) -> None:
        width = len(chars) // 2
        self.chars, self.tokens = chars, tokens
        self.text = [""] * width + pieces + [""] * (width - len(pieces))
        self.left, self.right = list(range(0, 2 * width, 2)) + [0] * width, list(range(1, 2 * width, 2)) + [0] * width
        self.up = [i >> 1 for i in range(2 * width)]
        self.emptied = 0

    def leaves(self) -> list[Leaf]:
        """The leaves that hold text, in order."""
        out, todo = [], [1]
        while todo:
            node = todo.pop()
            if self.chars[node]:
                if self.left[node]:
                    todo += (self.right[node], self.left[node])
                else:
                    out.append((self.text[node], self.chars[node], self.tokens[node]))
        return out

    def descend(self, at: int) -> tuple[int, int]:
        """(leaf, its start) of the leaf that holds the character ``at``; the last leaf with text if it lies behind."""
        node, start = 1, 0
        at = min(at, max(self.chars[1] - 1, 0))
        while self.left[node]:
            held = self.chars[self.left[node]]
            if at >= start + held:
                start += held
                node = self.right[node]
            else:
                node = self.left[node]
        return node, start

    def behind(self, node: int) -> Iterator[int]:
        """The leaves behind a leaf, in order."""
        while node != 1:
            parent = self.up[node]
            if self.left[parent] == node:
                node = self.right[parent]
                while self.left[node]:
                    node = self.left[node]
                yield node
            else:
                node = parent

    def plant(self, node: int, leaves: list[Leaf]) -> None:
        """Makes a leaf the root of a balanced subtree over new leaves."""
        if len(leaves) == 1:
            self.text[node], self.chars[node], self.tokens[node] = leaves[0]
            return
        half, ends = len(leaves) // 2, (self.left, self.right)
        self.text[node] = ""
        for end, part in zip(ends, (leaves[:half], leaves[half:])):
            end[node] = child = len(self.chars)
            for column, value in ((self.chars, 0), (self.tokens, 0), (self.left, 0), (self.right, 0), (self.up, node), (self.text, "")):
                column.append(value)
            self.plant(child, part)
        for tree in (self.chars, self.tokens):
            tree[node] = tree[self.left[node]] + tree[self.right[node]]

    def renew(self, node: int) -> int:
        """Renews the sums above a node; returns its depth."""
        depth = 0
        while node != 1:
            node = self.up[node]
            depth += 1
            for tree in (self.chars, self.tokens):
                tree[node] = tree[self.left[node]] + tree[self.right[node]]
        return depth

    def edit(self, start: int, end: int, new: str, counter: Counter) -> None:
        if start == end and not new:
            return
        first, at = self.descend(max(0, start - CONTEXT))
        behind = self.behind(first)
        taken, close = [first], [at + self.chars[first]]  # leaves looked at; where each ends in the old text

        def take(nodes) -> str:
            for node in nodes:
                taken.append(node)
                close.append(close[-1] + self.chars[node])
                yield self.text[node]

        old = self.text[first]
        while close[-1] < end:
            old += "".join(take(islice(behind, len(taken))))
        text = old[:start - at] + new + old[end - at:]
        back = at - len(new) + end - start  # from a place in ``text`` to the old text, behind the edit
        pieces: list[str] = []
        place, used, more = 0, 0, True
        while True:
            if place + back >= end:
                while used < len(close) and close[used] < place + back:
                    used += 1
                if used < len(close) and close[used] == place + back:
                    used += 1
                    break
            m = counter.pattern.match(text, place) if place < len(text) else None
            if more and (m is None or len(text) - m.end() < CONTEXT):  # what follows may change this pre-token
                before = len(taken)
                text += "".join(take(islice(behind, before)))
                more = len(taken) > before
            elif m is None:
                used = len(taken)
                break
            else:
                pieces.append(m[0])
                place = m.end()
        self.encoded += place
        grown = counter.cut(pieces) if len(pieces) > 2 * LEAF else [counter.leaf(pieces)]
        self.plant(first, grown)
        for node in taken[1:used]:
            self.plant(node, [("", 0, 0)])
            self.renew(node)
        self.emptied += used - 1
        depth, n_leaves = self.renew(first) + len(grown).bit_length(), len(self.chars) // 2
        if depth > 2 * n_leaves.bit_length() + 2 or 2 * self.emptied > n_leaves:
            self._lay(*trees(self.leaves()))


def trees(leaves: list[Leaf]) -> tuple[list[str], list[int], list[int]]:
    """The columns of a state: texts of the leaves, tree of characters, tree of tokens."""
    return [t for t, _, _ in leaves], build([c for _, c, _ in leaves]), build([n for _, _, n in leaves])


def clipped(edits: list[dict | None] | None, size: int) -> list[tuple[int, int, str]]:
    """Edits by start, inside the text and one behind the other."""
    out, behind = [], 0
    places = [(e["start"] or 0, e["end"] or 0, e["replacement"] or "") for e in edits or [] if e is not None]
    for start, end, new in sorted(places, key=lambda e: e[:2]):
        start = min(max(start, behind), size)
        behind = min(max(end, start), size)
        out.append((start, behind, new))
    return out


def _edits(df: DataFrame) -> Column:
    if "edits" not in df.columns:
        return F.lit(None).cast(EDITS)
    kind = df.schema["edits"].dataType.simpleString()
    if kind not in (EDITS, EDITS.replace("int", "bigint"), "void"):
        raise ValueError(f"edits must be {EDITS}, not {kind}")
    return F.col("edits").cast(EDITS)


def _ranks(spark: SparkSession, vocabulary: str):
    return spark.sparkContext.broadcast(ranks_of(vocabulary))


def _portions(batches: Iterator[pa.RecordBatch], size) -> Iterator[pa.RecordBatch]:
    """The rows of batches in portions of about ``SLICE_BYTES`` of text, a longer text alone or last in one."""
    for b in batches:
        ends = np.cumsum(np.asarray(size(b), dtype=np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), len(ends)]
        for lo, hi in zip(cuts, cuts[1:]):
            yield b.slice(lo, hi - lo)


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, pieces, chars, tokens, edits, n_tokens``: every text in leaves with its trees; other columns go."""
    ranks = _ranks(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for b in _portions(batches, lambda b: pc.binary_length(b.column(1))):
            states = [trees(counter.leaves(t.as_py())) for t in b.column(1)]
            kinds = (pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([t[i] for t in states], pa.list_(k)) for i, k in enumerate(kinds)), b.column(2)],
                ["doc_id", "pieces", "chars", "tokens", "edits"])

    rows = docs.select("doc_id", text_of().alias("text"), _edits(docs).alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, {STATE}, edits {EDITS}")
    return out.withColumn("n_tokens", F.col("tokens")[1].cast("long"))  # the root


def edited(state: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The state after its ``edits``: also ``n_tokens_before``, ``n_edits`` and ``n_encoded``, the characters encoded anew."""
    ranks = _ranks(state.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for b in _portions(batches, lambda b: pc.list_element(b.column("chars"), 1)):
            done = []
            for doc_edits, *parts in zip(*(b.column(n).to_pylist() for n in ("edits", "pieces", "chars", "tokens"))):
                edits, encoded = clipped(doc_edits, parts[1][1]), 0
                if edits:
                    doc = Document(*parts)
                    for start, end, new in reversed(edits):  # places before stay valid
                        doc.edit(start, end, new, counter)
                    parts, encoded = trees(doc.leaves()), doc.encoded
                done.append((*parts, len(edits), encoded))
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)),
                 b.column("n_tokens_before")],
                ["doc_id", "pieces", "chars", "tokens", "n_edits", "n_encoded", "n_tokens_before"])

    rows = state.withColumn("edits", _edits(state)).withColumnRenamed("n_tokens", "n_tokens_before")
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", "pieces", "chars", "tokens", "edits", "n_tokens_before").mapInArrow(
        run, f"doc_id {kind}, {STATE}, n_edits long, n_encoded long, n_tokens_before long")
    return out.withColumn("n_tokens", F.col("tokens")[1].cast("long"))


def revision_edits(state: DataFrame) -> DataFrame:
    """A counted ``state`` with five more ``edits`` per text that is not empty, as a revision would make them.

    At places hashed from the id: words put in at a leaf's edge, seven
    characters taken out, three replaced, a leaf's first blank widened or
    removed, and in one text of eight a paragraph pasted in (in the others an
    empty edit).  Empty texts get none.
    """
    size = F.greatest(F.col("chars")[1], F.lit(1))
    n_leaves = F.greatest(F.size("pieces"), F.lit(1))

    def draw(k: int, n: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(k)), n).cast("int")

    def before(leaf: Column) -> Column:
        """Where a leaf begins."""
        held = F.slice("chars", (F.size("chars") / 2).cast("int") + 1, leaf)
        return F.aggregate(held, F.lit(0), lambda a, c: a + c)

    def change(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("replacement"))

    edge, leaf, cut, put, paste = before(draw(1, n_leaves)), draw(2, n_leaves), draw(3, size), draw(4, size), draw(5, size)
    blank = F.instr(F.coalesce(F.get("pieces", leaf), F.lit("")), " ")
    at_blank = before(leaf) + F.greatest(blank, F.lit(1)) - 1
    made = F.array(
        change(edge, edge, F.lit(" as of 2024 ")),
        change(cut, cut + 7, F.lit("")),
        change(put, put + 3, F.lit("'ll be")),
        change(at_blank, at_blank + F.least(blank, F.lit(1)), F.when(draw(6, F.lit(2)) == 0, "").otherwise("\n  ")),
        change(paste, paste, F.when(draw(7, F.lit(8)) == 0, F.repeat(F.lit(" a pasted paragraph, it's longer."), 40)).otherwise("")))
    old = F.coalesce(_edits(state), F.array().cast(EDITS))
    return state.withColumn("edits", F.when(F.col("chars")[1] > 0, F.concat(old, made)).otherwise(old))


def number_edits(docs: DataFrame, replacement: str = "<num>") -> DataFrame:
    """``docs`` with ``edits`` that replace every run of four digits and more."""
    long_run = regex.compile("[0-9]{4,}")
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _portions(batches, lambda b: pc.binary_length(b.column(1))):
            edits = [[{"start": m.start(), "end": m.end(), "replacement": replacement}
                      for m in long_run.finditer(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edits, shape)], ["doc_id", "text", "edits"])

    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string, edits array<struct<start:int,end:int,replacement:string>>")
