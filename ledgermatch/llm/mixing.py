"""Mixing sources to target weights by Pfair scheduling, on built-in functions only.

The documents of a source, in an order given by their hash, form blocks of
``block_docs``.  A source's target weight becomes a share ``a / A`` of the
slots, exact to parts of 10**11.  Its block number k may run from slot
``floor(k A / a)`` (release) and must run before slot ``ceil((k + 1) A / a)``
(deadline).  In each slot the released block with the earliest deadline runs,
ties by source.  Every block meets its deadline, so after every slot each
source has had its share to within less than one block, however many slots.

The schedule is computed in stretches of slots that run in parallel.  What has
run when a stretch begins, at slot t, follows from t alone: each source has had
the whole part of ``t a / A`` blocks, and some have had the block that t falls
into as well.  Which ones is settled between two limits: blocks that are due
soon behind t must be among them as far as the slots behind t do not suffice
(earliest deadline first); of those the earliest released are taken, as the
slots before t may not hold more of the late ones.  Both limits can be met at
any t, since earliest-deadline-first from slot 0 meets them.  Blocks of a
stretch then have their windows cut to it, and earliest-deadline-first fits them
in.  A stretch is longer than any window, so no window crosses two of its ends.

* A stretch is one row, and so are the shares of all sources: a mixture of tens
  to thousands of sources.  Work per slot grows with the sources.
* Documents are numbered within their source without a task that sees a whole
  source: rows are counted by hash prefix, the counts become offsets level by
  level (16 rows to a window), and rows are ranked inside a prefix only.  The
  slots of a prefix's few blocks come with its offset, so documents are not
  shuffled once more for them, and nothing is broadcast by hint.
* No document is dropped.  Once a source has run out its slots stay empty, and
  the others keep their places; the order of the mix is ``slot, place``.

A null source is a source of its own.  A source without a positive target
weight, or with a share below ``LEAST_SHARE``, gets that share before shares are
made to add up to one.  Without any positive weight all shares are equal.
Repeated rows are ranked one after the other.  Further columns pass through;
names that begin with a double underscore are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_of, written

BLOCK_DOCS = 100
ROWS_PER_PREFIX = 20_000
#: Slots of a stretch at least.
STRETCH = 1000
#: A share is a whole number of these parts.
PARTS = 10 ** 11
LEAST_SHARE = 1e-5
#: Slots that are put together before they join those of the stretch.
CHUNK = 500


def source_key(source: str = "source") -> Column:
    """Never null: a null source differs from an empty one."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def root_weights(docs: DataFrame) -> DataFrame:
    """Target weights proportional to the square root of a source's documents: ``__src, weight, n``."""
    return (docs.groupBy(source_key().alias("__src")).agg(F.count(F.lit(1)).alias("n"))
            .select("__src", F.floor(F.sqrt("n") * 1_000_000).alias("weight"), "n"))


def shares(sizes: DataFrame, block_docs: int = BLOCK_DOCS, stretch: int = STRETCH) -> DataFrame:
    """One row for ``__src, weight, n``: ``s`` (``src, a, blocks`` by source), ``whole``, ``length`` (slots of a stretch), ``total`` slots, ``stretches``."""
    w = F.greatest(F.coalesce(F.col("weight"), F.lit(0)), F.lit(0)).cast("double")
    one = sizes.select("__src", w.alias("w"), "n").agg(F.array_sort(F.collect_list(F.struct("__src", "w", "n"))).alias("all"))
    one = one.withColumn("sum", F.expr("aggregate(all, 0D, (t, x) -> t + x.w)"))
    least = round(LEAST_SHARE * PARTS)
    part = f"greatest({least}L, cast(if(sum > 0, floor(x.w / sum * {PARTS} + 0.5D), 0) as bigint))"
    one = one.select(F.expr(f"transform(all, x -> named_struct('src', x.__src, 'a', {part}, "
                            f"'blocks', cast(ceil(x.n / {block_docs}) as bigint)))").alias("s"))
    one = one.withColumn("whole", F.expr("aggregate(s, 0L, (t, x) -> t + x.a)"))
    one = one.withColumn("length", F.expr(f"greatest({stretch}L, (whole + array_min(s.a) - 1) div array_min(s.a) + 1)"))
    ends = "ceil(cast(x.blocks as decimal(18,0)) * cast(whole as decimal(18,0)) / cast(x.a as decimal(12,0)))"
    one = one.withColumn("total", F.expr(f"array_max(transform(s, x -> cast({ends} as bigint)))"))
    return one.withColumn("stretches", F.expr("cast(ceil(total / length) as bigint)")).where("size(s) > 0")


#: Of each source at slot ``t``: blocks it has had for certain, the part of the next one in A-ths, and how far the
#: release of that block lies before t and its deadline behind.
_AT = """transform(s, x -> named_struct('a', x.a,
    'k', cast(cast({t} as decimal(18,0)) * cast(x.a as decimal(12,0)) div cast(whole as decimal(18,0)) as bigint),
    'f', cast(cast({t} as decimal(18,0)) * cast(x.a as decimal(12,0)) % cast(whole as decimal(18,0)) as bigint)))"""
#: Slots up to ``d`` behind t that blocks released behind t leave free.
_FREE = "({d} - aggregate(b, 0L, (n, x) -> n + greatest(0L, (x.f + {d} * x.a) div whole - if(x.f > 0, 1L, 0L))))"
#: Places of the sources that have had the block which t falls into.
_AHEAD = f"""aggregate(
    array_sort(filter(transform(b, (x, i) -> named_struct('due', (whole - x.f + x.a - 1) div x.a, 'i', i,
                                                          'since', (x.f + x.a - 1) div x.a, 'open', x.f > 0)), y -> y.open)),
    named_struct('n', 0L, 'ahead', cast(array() as array<int>), 'pool', cast(array() as array<struct<since: bigint, i: int>>)),
    (st, y) -> transform(array(named_struct(
        'pool', array_sort(array_append(st.pool, named_struct('since', -y.since, 'i', y.i))),
        'need', cast(greatest(0L, st.n + 1 - {_FREE.format(d="y.due")} - size(st.ahead)) as int))),
      z -> named_struct('n', st.n + 1, 'ahead', concat(st.ahead, slice(z.pool, 1, z.need).i),
                        'pool', slice(z.pool, z.need + 1, size(z.pool))))[0],
    st -> concat(st.ahead, slice(st.pool, 1, cast(aggregate(b, 0L, (n, x) -> n + x.f) div whole as int) - size(st.ahead)).i))"""

#: Earliest deadline first: of each slot the source's place and its block.
_PICK = """array_min(transform(st.q, (q, i) -> CASE
    WHEN (m[i] IS NULL OR q < m[i]) AND e[i] + q * whole < (tau + 1) * s[i].a
    THEN least((e[i] + (q + 1) * whole + s[i].a - 1) div s[i].a, coalesce(m[i] * 0 + length, 9000000000000L)) * 1000000 + i END)) % 1000000"""
_CHUNK = f"""aggregate(sequence(c * {CHUNK}, least(c * {CHUNK} + {CHUNK - 1}, span - 1)),
    named_struct('q', st0.q, 'out', cast(array() as array<struct<i: int, block: bigint>>)),
    (st, tau) -> transform(array(cast({_PICK} as int)), pick -> named_struct(
        'q', transform(st.q, (n, i) -> n + if(i = pick, 1L, 0L)),
        'out', array_append(st.out, named_struct('i', pick, 'block', c0[pick] + st.q[pick]))))[0])"""
_RUN = f"""flatten(aggregate(sequence(0L, (span - 1) div {CHUNK}),
    named_struct('q', transform(s, x -> 0L), 'out', cast(array() as array<array<struct<i: int, block: bigint>>>)),
    (st0, c) -> transform(array({_CHUNK}), z -> named_struct('q', z.q, 'out', array_append(st0.out, z.out)))[0],
    st0 -> st0.out))"""


def _begun(t: str) -> str:
    """Per source before slot ``t``: blocks that have run (``c``), and how far ahead of its share that is (``e``, in parts)."""
    # Bound as lambda variables, so that each is evaluated once.
    return (f"transform(array({_AT.format(t=t)}), b -> transform(array({_AHEAD}), w -> transform(b, (x, i) -> "
            "named_struct('c', x.k + if(array_contains(w, i), 1L, 0L), 'e', if(array_contains(w, i), whole, 0L) - x.f)))[0])[0]")


def schedule(table: DataFrame) -> DataFrame:
    """The slot of every block of ``shares``: ``__src, block, slot``; one row of work per stretch."""
    rows = table.withColumn("j", F.explode(F.expr("sequence(0L, stretches - 1)"))).repartition("j")
    rows = rows.select("*", F.expr(_begun("j * length")).alias("now"), F.expr(_begun("(j + 1) * length")).alias("then"))
    rows = cut(rows)
    # The last stretch has no end to fit in.
    rows = cut(rows.select("s", "whole", "length", "j", F.expr("least(length, total - j * length)").alias("span"), F.expr("now.c").alias("c0"), F.expr("now.e").alias("e"),
                           F.expr("transform(now, (x, i) -> if(j < stretches - 1, then[i].c - x.c, null))").alias("m")))
    picks = rows.select("s", "j", "length", F.posexplode(F.expr(_RUN)).alias("at", "pick"))
    picks = picks.withColumn("own", F.expr("s[pick.i]")).where("pick.block < own.blocks")
    return picks.select(F.col("own.src").alias("__src"), F.col("pick.block").alias("block"), F.expr("j * length + at").alias("slot"))


def numbered(docs: DataFrame, rows: int, rows_per_prefix: int = ROWS_PER_PREFIX, slots: DataFrame | None = None,
             block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Adds ``__src`` and ``__no``, the document's number in its source by hash order, from zero.

    With ``slots`` (``__src, block, slot``) also ``__slots``, those of the
    blocks that the row's hash prefix reaches, and ``__first``, the first of these blocks.
    """
    depth = 1
    while rows > rows_per_prefix * 16 ** depth:
        depth += 1
    hashed = docs.withColumns({
        "__src": source_key(),
        "__h": F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of()).cast("binary"))})
    hashed = hashed.withColumn("__p", F.substring("__h", 1, depth))
    counts = hashed.groupBy("__src", "__p").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("__src", "__p", F.lit(0).cast("long").alias("__off"))
    for level in range(1, depth + 1):
        parent, own = F.substring("__p", 1, level - 1), F.substring("__p", 1, level)
        at = counts.groupBy("__src", parent.alias("up"), own.alias("own")).agg(F.sum("n").alias("n"))
        before = (Window.partitionBy("__src", "up").orderBy("own")
                  .rowsBetween(Window.unboundedPreceding, -1))  # 16 rows at most
        at = at.select("__src", "own", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("add"))
        offsets = (offsets.withColumn("own", own).join(at, ["__src", "own"])
                   .select("__src", "__p", (F.col("__off") + F.col("add")).alias("__off")))
    if slots is not None:
        ends = offsets.join(counts, ["__src", "__p"]).select(
            "__src", "__p", "__off", F.floor(F.col("__off") / block_docs).alias("__first"),
            F.floor((F.col("__off") + F.col("n") - 1) / block_docs).alias("last"))
        found = ends.withColumn("block", F.explode(F.sequence("__first", "last"))).join(slots, ["__src", "block"])
        offsets = (found.groupBy("__src", "__p", "__off", "__first")  # ROWS_PER_PREFIX / block_docs blocks, about
                   .agg(F.array_sort(F.collect_list(F.struct("block", "slot")))["slot"].alias("__slots")))
    order = Window.partitionBy("__src", "__p").orderBy("__h", F.xxhash64(*docs.columns))
    ranked = hashed.withColumn("__r", F.row_number().over(order))
    return (ranked.join(offsets, ["__src", "__p"])
            .withColumn("__no", F.col("__off") + F.col("__r") - 1).drop("__p", "__h", "__r", "__off"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS,
          stretch: int = STRETCH) -> DataFrame:
    """``docs`` with ``block``, ``slot`` and ``place`` (in the block); columns of these names are replaced.

    ``weights`` has ``source`` and ``weight``, one row per source of the
    mixture; without it the weights follow the square root of the sizes.
    """
    if clash := [c for c in docs.columns if c.startswith("__")]:
        raise ValueError(f"columns that begin with a double underscore are used inside: {clash}")
    docs = docs.drop("block", "slot", "place")
    sizes = root_weights(docs)
    if weights is not None:
        given = weights.groupBy(source_key().alias("__src")).agg(F.sum("weight").alias("weight"))
        sizes = sizes.select("__src", "n").join(given, "__src", "left")
    sizes = cut(sizes)
    slots = written(schedule(shares(sizes, block_docs, stretch)), "mix-slots")
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    placed = numbered(docs, rows, slots=slots, block_docs=block_docs)
    placed = placed.withColumn("block", F.floor(F.col("__no") / block_docs))
    return (placed.withColumns({"slot": F.get("__slots", (F.col("block") - F.col("__first")).cast("int")),
                                "place": F.col("__no") % block_docs})
            .select(*docs.columns, "block", "slot", "place"))


def interleaved(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS,
                stretch: int = STRETCH) -> DataFrame:
    """``mixed`` laid out in the order of the mix: partitions by range of slots, sorted inside."""
    return mixed(docs, weights, block_docs, stretch).repartitionByRange("slot", "place").sortWithinPartitions(
        "slot", "place")


# DuckDB SQL of ``mixed`` over documents, without the text: earliest deadline first from slot 0, for a mix of one stretch
ORACLE = """
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS src,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents),
w AS (SELECT src, count(*) AS n, floor(sqrt(count(*)) * 1000000)::BIGINT AS w FROM d GROUP BY src),
sh AS MATERIALIZED (SELECT src, greatest(1000000, ((w::HUGEINT * 200000000000 + sum(w) OVER ()) // (2 * sum(w) OVER ())))::HUGEINT AS a,
       ceil(n / 100)::BIGINT AS blocks FROM w),
s AS MATERIALIZED (SELECT list(a ORDER BY src) AS a, sum(a)::HUGEINT AS p, count(*) AS n,
       (SELECT max((blocks * (SELECT sum(a) FROM sh) + a - 1) // a) FROM sh)::BIGINT AS slots FROM sh),
e(t, k, pick) AS (
  SELECT -1::BIGINT, (SELECT list_transform(a, lambda x: 0::BIGINT) FROM s), 0::BIGINT
  UNION ALL
  SELECT t, list_transform(range(1, n + 1), lambda i: k[i] + (i = pick)::BIGINT), pick FROM (
    SELECT e.t + 1 AS t, e.k, s.n, (list_min(list_filter(list_transform(range(1, s.n + 1), lambda i:
      CASE WHEN (e.k[i] * s.p) // s.a[i] <= e.t + 1
           THEN (((e.k[i] + 1) * s.p + s.a[i] - 1) // s.a[i]) * 1000000 + i END), lambda x: x IS NOT NULL)) % 1000000)::BIGINT AS pick
    FROM e, s WHERE e.t + 1 < s.slots)),
sl AS MATERIALIZED (SELECT src, list(t ORDER BY t) AS slots FROM e
      JOIN (SELECT src, row_number() OVER (ORDER BY src) AS i FROM sh) ON i = pick WHERE t >= 0 GROUP BY src),
r AS (SELECT doc_id, source, src, row_number() OVER (PARTITION BY src ORDER BY h) - 1 AS no FROM d)
SELECT doc_id, source, (no // 100)::BIGINT AS block, slots[no // 100 + 1]::BIGINT AS slot, (no % 100)::BIGINT AS place
FROM r JOIN sl USING (src)
"""
