"""SimHash near-duplicates by pigeonhole blocks.

A document's fingerprint has a bit set where more than half of its shingle
hashes have it set.  Two fingerprints link if they differ in at most
``max_distance`` bits; a component is what links reach.

* Equal fingerprints collapse to one row first (partial aggregation), so a
  group of exact copies of any size costs one row from there on.
* Pigeonhole: the 64 bits are cut into ``max_distance + 2`` blocks.  A close
  pair differs in at most ``max_distance`` blocks, hence agrees on two whole
  blocks at least.  One key per pair of blocks, join on the key, verify the
  Hamming distance.
* A key that more than ``bucket_limit`` different fingerprints share is not
  joined with itself.  Its fingerprints are linked exactly by one-bit
  neighbours instead: a pair at distance <= 2 has a common neighbour at
  distance <= 1 of both, and all the fingerprints around one such centre (65
  at most) are within distance 2 of each other, so a star over them loses no
  component.  For larger distances the centres are taken ``max_distance // 2``
  and rounded up bits away, and the links are verified.
* Components by alternating large-star and small-star steps over the links
  between different fingerprints, each step cut by a checkpoint.

``doc_id`` is an integer; a text id that is no number is an error.  Null texts
count as empty; texts without words have fingerprint zero and link
like any other.  Rows with a null ``doc_id`` take part but cannot name a
component, so a component of such rows alone has a null ``component_id``.
Repeated rows are kept as they are.  Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)))))
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), 255 * 64):
        part = shingles[at:at + 255 * 64]
        digests = np.frombuffer(b"".join([xxhash.xxh64_digest(s, SEED) for s in part]), dtype=np.uint8)
        # one byte per bit, added eight bytes at a time; 255 rows cannot overflow a byte
        lanes = np.unpackbits(digests).reshape(len(part), BITS).view(np.uint64)
        sums = np.add.reduceat(lanes, np.arange(0, len(part), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(shingles)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long), one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in b.column(1)),
                              dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_masks(max_distance: int) -> list[int]:
    """A bit mask for each pair of the ``max_distance + 2`` blocks."""
    n = max_distance + 2
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(distinct: DataFrame, max_distance: int = 2, bucket_limit: int = 64) -> DataFrame:
    """Links ``a, b`` that connect just what the distance does, from a table ``fp`` of different fingerprints."""
    masks = [F.lit(_signed(m)) for m in block_masks(max_distance)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(m) for m in masks]))
                            .alias("blk", "key"))
    sizes = keyed.groupBy("blk", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = cut(keyed.join(sizes, ["blk", "key"]))
    left = small.where(F.col("n") <= bucket_limit).select("blk", "key", F.col("fp").alias("a"))
    right = small.where(F.col("n") <= bucket_limit).select("blk", "key", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # a pair that agrees on several keys is kept at the first of them
    first = reduce(lambda acc, im: acc & ((F.col("blk") <= im[0]) | (diff.bitwiseAND(im[1]) != 0)),
                   enumerate(masks), F.lit(True))
    near = (left.join(right, ["blk", "key"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_distance) & first).select("a", "b"))
    crowded = small.where(F.col("n") > bucket_limit).select("fp").distinct()
    return near.unionByName(star_links(crowded, max_distance))


def star_links(distinct: DataFrame, max_distance: int) -> DataFrame:
    """Links through common neighbours: exact for any number of fingerprints, work linear in it."""
    radius = (max_distance + 1) // 2
    flips = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(BITS), r)]
    around = distinct.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(x))) for x in flips]))
                             .alias("centre"))
    # a ball of that radius holds len(flips) fingerprints at most, so the list is bounded
    balls = around.groupBy("centre").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1)
    if max_distance == 2 * radius:
        return balls.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a < b")
    pairs = balls.select(F.explode("near").alias("a"), "near").select("a", F.explode("near").alias("b"))
    return pairs.where((F.col("a") < F.col("b"))
                       & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node reachable."""
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lower.select("u", F.col("m").alias("v"))))
        now = cut(small.where("u != v").distinct())


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2,
                    bucket_limit: int = 64) -> DataFrame:
    """``doc_id, fp, root, component_id``, one row per document.

    ``root`` is the smallest fingerprint of the component (never null),
    ``component_id`` its smallest document id.
    """
    per_doc = cut(fingerprints(docs, shingle_words))
    distinct = per_doc.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = connected(links(distinct.select("fp"), max_distance, bucket_limit))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.select("fp", "root").join(best, "root")
    return per_doc.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def one_per_component(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays.

    Columns are those of ``docs``.  Rows that share the smallest id of a
    component (repeated rows, or rows without an id) are told apart by their
    remaining columns, the smallest values first, and one stays.
    """
    near = cut(near_duplicates(docs, shingle_words, max_distance))
    heads = F.col("doc_id").eqNullSafe(F.col("component_id"))
    own = "__id"  # the only name beside those of the input
    while own in {c.lower() for c in docs.columns}:
        own += "_"
    per_id = (near.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"), F.count_if(heads).alias("__heads"))
              .where("__heads > 0").withColumnRenamed("doc_id", own))
    rows = docs.withColumn(own, F.col("doc_id").cast("long"))
    # An id of one row, which heads its component, needs no look at the row.
    plain = rows.join(per_id.where((F.col("__n") == 1) & F.col(own).isNotNull()).select(own), own, "left_semi")
    several = cut(per_id.where((F.col("__n") > 1) | F.col(own).isNull()).select(F.col(own).alias(f"{own}_i")))
    if several.isEmpty():
        return plain.select(*docs.columns)
    some = rows.join(several, rows[own].eqNullSafe(several[f"{own}_i"]), "left_semi")
    keyed = some.select(F.struct(*docs.columns).alias("__row"), F.col(own).alias("__id"),
                        F.xxhash64(*docs.columns).alias("__h"))
    fps = fingerprints(keyed.select(F.col("__h").alias("doc_id"), F.col("__row.text").alias("text")), shingle_words)
    fps = fps.distinct().select(F.col("doc_id").alias("__h"), "fp")
    roots = near.where(heads).select(F.col("doc_id").alias("__i"), "fp", "root").distinct()
    with_fp = keyed.join(fps, "__h")
    headed = with_fp.join(roots, with_fp["__id"].eqNullSafe(roots["__i"]) & (with_fp["fp"] == roots["fp"]))
    best = headed.groupBy("root").agg(F.min("__row").alias("__row"))
    return plain.select(*docs.columns).unionByName(best.select("__row.*"))

