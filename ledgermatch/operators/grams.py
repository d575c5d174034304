"""Candidate pairs by shared characters: a similarity join on sets of 3-grams.

Two names are candidates if the Jaccard similarity of their 3-gram sets is at
least ``t`` (a name is padded with two blanks before and one behind, so that
beginnings weigh more).  It finds what shares no whole token: misspelt, joined
or cut names.  The join is exact, by inverted lists with three filters:

* **Live grams**: a gram counts for names of n grams if a name of the other side
  holds it whose number of grams m fits (``t n <= m <= n / t``); only such grams can
  be shared.  A name of too few is not listed, nor is one without a partner's size.
* **Prefix**: live grams are ordered from rare to common.  Names of n and m grams
  share ``ceil(t / (1 + t) (n + m))`` at least; ``need`` is the least of it for the sizes
  that the other side has.  Of v live grams the rarest shared
  one is among the first ``v - need + 1`` of each name; only those are listed.
* **Pairs**: the list of a gram that many names hold is not joined.  Its names meet
  by the two rarest grams that they share, which are among the first
  ``v - need + 2`` of each; only names that may share a single gram
  (``need < 2``) are listed under a common gram alone, too.
* **Position**: a pair whose first shared gram is at places i and j of v and w live
  grams shares ``1 + min(v - i, w - j)`` at most; one whose second is there shares one more.
* **Signs**: a name's live grams set bits of two longs by their hash.  A bit that
  only one name of a pair has is a gram that they do not share, so these are
  counted before a pair leaves the join.
* **Count**: the grams both share are counted, and the similarity computed.

Lists hold hashes of keys and names, and the names are fetched for the few pairs that are
left.  Two names of one hash would only add pairs, which the count drops.  Grams are counted
once; while they are ``BROADCAST_GRAMS`` at most, ordering a name's grams needs no shuffle.

A list of many names is dealt to buckets on both sides, so no gram is dropped
for being common and no task holds a whole list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .edit_distance import _cut, dealt_join, tasks

GRAM = 3
DEFAULT_MIN_SIMILARITY = 0.7
#: Names that hold a gram of more names than this meet by two grams.
HOT_NAMES = 200
#: Rows of (gram, size of name) that are sent to every task; more are joined by shuffle.
BROADCAST_GRAMS = 1_000_000
_EPS = 1e-9


def gram_set(name: Column) -> Column:
    """Distinct 3-grams of the padded name."""
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) + 1),
                                        lambda i: F.substring(padded, i, F.lit(GRAM))))


def _cut_again(name: Column) -> Column:
    """The 3-grams of ``gram_set``, with repeats; names of ASCII alone are cut by a pattern, which is compiled."""
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return F.when(F.octet_length(name) == F.length(name), F.regexp_extract_all(padded, F.lit("(?s)(?=(.{3}))"), F.lit(1))).otherwise(gram_set(name))


def _needed(t: float) -> Column:
    """The grams that names of ``n`` and ``m`` grams share at least."""
    return F.ceil(F.lit(t / (1 + t)) * (F.col("n") + F.col("m")) - _EPS).cast("int")


def _fitting(df: DataFrame, t: float, size: str, other: str) -> DataFrame:
    """``df`` once for each ``other``, the sizes that a partner may have."""
    return df.withColumn(other, F.explode(F.expr(f"sequence(cast(ceil({t}D * {size} - {_EPS}D) as int), cast(floor({size} / {t}D + {_EPS}D) as int))")))


def _live(own: DataFrame, others: DataFrame, freq: DataFrame, t: float, size: str, other: str) -> DataFrame:
    """``gram, <size>, df, need`` of the grams that names of ``size`` grams can share."""
    fitting = _fitting(own, t, size, other).join(others, ["gram", other]).select("gram", size).distinct()
    needs = (_fitting(own.select(size).distinct(), t, size, other).join(others.select(other).distinct(), other)
             .groupBy(size).agg(F.min(_needed(t)).alias("need")))
    live = _cut(fitting.join(freq, "gram").join(needs, size))
    return F.broadcast(live) if live.count() <= BROADCAST_GRAMS else live


def _listed(side: DataFrame, live: DataFrame, name: str, size: str, live_left: str, p: str) -> DataFrame:
    """One row per name and key (one rare gram, or two) of its prefix: hashes of both, ``size``, the live grams
    from the key's last on as ``live_left``, and the name's signs and number of live grams, which begin with ``p``."""
    bit = F.pmod(F.xxhash64("gram"), F.lit(128)).cast("int")
    one = F.lit(1).cast("long")
    signs = [F.bit_or(F.when((bit >= low) & (bit < low + 64), F.call_function("shiftleft", one, bit - low)).otherwise(F.lit(0).cast("long"))).alias(f"{p}{h}")
             for h, low in (("a", 0), ("b", 64))]
    ordered = (side.join(live, ["gram", size]).groupBy(name, size, "need")
               .agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("ordered"), *signs)
               .withColumn(f"{p}v", F.size("ordered")).where(f"{p}v >= need"))
    ordered = ordered.withColumn("heads", F.expr(f"slice(ordered, 1, {p}v - need + 2)")).drop("ordered")
    hot = f"x.df > {int(HOT_NAMES)}"
    singles = f"""filter(transform(heads, (x, i) -> struct(xxhash64(x.gram) AS key, i AS at, i <= {p}v - need AND (need < 2 OR NOT {hot}) AS used)),
        k -> k.used)"""
    pairs = f"""flatten(transform(heads, (x, i) -> transform(slice(heads, i + 2, if({hot}, size(heads), 0)),
        (y, j) -> struct(xxhash64(x.gram, y.gram) AS key, i + j AS at, true AS used))))"""
    listed = ordered.withColumn("k", F.explode(F.expr(f"concat({singles}, {pairs})")))
    return listed.select(F.xxhash64(name).alias(f"{p}id"), size, f"{p}v", f"{p}a", f"{p}b",
                         (F.col(f"{p}v") - F.col("k.at")).alias(live_left), "k.key")


def _unshared(p: str, q: str) -> Column:
    """Grams of ``p`` that ``q`` lacks, at least."""
    return sum((F.bit_count(F.col(f"{p}{h}").bitwiseAND(F.bitwise_not(f"{q}{h}"))) for h in "ab"), F.lit(0))


def candidate_pairs_by_grams(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                             min_similarity: float = DEFAULT_MIN_SIMILARITY,
                             right_extra: tuple[str, ...] = ("choice_ord",)) -> DataFrame:
    """M4: every pair with 3-gram similarity of ``min_similarity`` or more: ``s, r, <right_extra>, inter, similarity``."""
    t = float(min_similarity)
    if not 0.0 < t <= 1.0:
        raise ValueError("min_similarity must be in (0, 1]")
    rx = list(right_extra)
    L = left.select(F.col(left_key).alias("s")).where("s <> ''")
    R = right.select(F.col(right_key).alias("r"), *rx).where("r <> ''")

    def exploded(names: DataFrame, name: str, size: str) -> DataFrame:
        # In place by name, so that its grams need no shuffle to come together again.
        grams = names.select(name).repartition(tasks(names), name).distinct().withColumn("grams", gram_set(F.col(name)))
        return grams.select(name, F.size("grams").alias(size), F.explode("grams").alias("gram"))

    le, re = exploded(L, "s", "n"), exploded(R, "r", "m")
    lefts, rights = (_cut(x.groupBy("gram", size).agg(F.count(F.lit(1)).alias("held"))) for x, size in ((le, "n"), (re, "m")))
    freq = lefts.select("gram", "held").unionByName(rights.select("gram", "held")).groupBy("gram").agg(F.sum("held").alias("df"))
    close = ((F.least("n", "m") >= t * F.greatest("n", "m") - _EPS) & (F.least("i", "j") >= _needed(t))
             & (F.least(F.col("sv") - _unshared("s", "r"), F.col("rv") - _unshared("r", "s")) >= _needed(t)))
    lists = (_listed(le, _live(lefts, rights, freq, t, "n", "m"), "s", "n", "i", "s"),
             _listed(re, _live(rights, lefts, freq, t, "m", "n"), "r", "m", "j", "r"))
    met = dealt_join(*lists, ["key"], "sid", "rid", close).select("sid", "rid", "n", "m").distinct()  # a pair meets at several keys
    named = (met.join(L.distinct().withColumn("sid", F.xxhash64("s")), "sid").join(R.withColumn("rid", F.xxhash64("r")), "rid")
             .select("s", "r", *rx).dropDuplicates(["s", "r"]))
    both = named.withColumns({"x": _cut_again(F.col("s")), "y": _cut_again(F.col("r"))})
    counted = both.select("s", "r", *rx, F.size(F.array_intersect("x", "y")).alias("inter"), F.size(F.array_distinct("x")).alias("n"),
                          F.size(F.array_distinct("y")).alias("m"))
    similarity = F.col("inter") / (F.col("n") + F.col("m") - F.col("inter"))
    return (counted.withColumn("similarity", similarity).where(F.col("similarity") >= t - _EPS)
            .select("s", "r", *rx, "inter", "similarity"))
