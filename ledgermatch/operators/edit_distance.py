"""Best matches by edit distance, exact and without a filter on tokens.

Similarity is ``1 - distance / longer length``.  Scoring every supplier against
every register name is what this avoids: a lower bound on each supplier's k-th
best similarity comes first, and it says how far the search must go.

1. **Seeds**: the best pairs by shared tokens (``matching.best_pairs``, at most k
   per token subset and length), scored by edit distance.  The k-th of them is
   the supplier's bound.
2. **Segment index**, once per rung of ``RUNGS``, for suppliers whose bound is
   below the rung before.  Names within distance d share one of d + 1 segments of
   the register name unchanged, near the same place: register names are cut
   into segments for the distances that the rung allows, suppliers look up the
   substrings that can line up with them.  After a rung every pair at its
   similarity is known, so a supplier whose new bound reaches the rung is done.
3. **The rest**: suppliers with fewer than k names at the last rung.  Names meet
   by class of length and digits, dealt to buckets on both sides, and only
   within the lengths that the supplier's bound allows.

Where many register names hold a supplier's segments (``BRAND``, `` LTD``), the
lists would bring it more rows than its classes of length and digits have names;
it meets these classes whole instead (``_scanned``).  Digits that a supplier
lacks are all the same to it: register names that differ only in these have one
distance from it, and the first k of them by ``choice_ord`` are all that can
count.  So it meets one name of each such group, and the others follow the best k groups.

Names that differ by a few digits (``CUSTOMER 000012345 LTD``) share most
segments, so they meet by their digits instead.  Names of n and m characters
within distance d have ``max(n, m) - d`` characters in common at least, in order.
So ``u = d - (max(n, m) - n)`` characters of one and ``v = d - (max(n, m) - m)`` of
the other are left over at most, among them its digits, and the digits
of both share a subsequence of ``max(p - u, q - v)`` for p and q digits.  Names of
``MIN_DIGITS`` digits and more meet by that subsequence where it leaves out
``MAX_LEFT_OUT`` digits of either name at most, else by segments and the number of
digits.

Before any distance is computed, a pair must pass a bound from its characters:
each name carries unary counts of 37 characters in two longs, and every
character in excess costs an edit.  The distance itself is Spark's banded
``levenshtein`` with the pair's own limit.  All joins are equi-joins; keys of
many names are dealt to buckets (``dealt_join``), so no task holds one whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

RUNGS = (0.85, 0.75)
#: A key that more rows of one side share is dealt to buckets of about so many.
ROWS_PER_BUCKET = 5000
#: Steps of a length class per doubling of the length.
CLASSES_PER_DOUBLING = 8
#: Names of fewer digits are in one class; names of so many or more are classed by their number.
MIN_DIGITS = 6
#: Digits of a name that may be left out when names meet by their digits.
MAX_LEFT_OUT = 2
#: Sets of digits by which numbered names are grouped; suppliers with rarer sets meet these names one by one.
MAX_DIGIT_SETS = 64
#: Names per bucket where whole classes meet: their rows are few bytes, but many pairs.
SCANNED_PER_BUCKET = 1000
COUNTED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
_EPS = 1e-9


def tasks(df: DataFrame) -> int:
    """Tasks for a step with much work per byte: AQE would put the few bytes of its input in few tasks."""
    spark = df.sparkSession
    return max(4 * max(spark.sparkContext.defaultParallelism, 8), int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in ``tasks``; an expression of ``key``, as Spark drops a repartitioning by a key that it has already."""
    return df.repartition(tasks(df), F.xxhash64(key))


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, condition: Column,
               rows: int | None = None, many_tasks: bool = False) -> DataFrame:
    """Equi-join on ``keys`` with ``condition``; a hot key's rows are dealt to buckets by their ids.

    Each side's row goes to one bucket of its own and to every bucket of the
    other side, so all pairs meet once, and a task reads two buckets at most.
    With ``many_tasks`` it runs in many tasks, however few bytes the rows have.
    """
    rows = rows or ROWS_PER_BUCKET
    lefts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__lefts"))
    rights = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rights"))
    hot = (lefts.join(rights, keys).where((F.col("__lefts") > rows) | (F.col("__rights") > rows))
           .select(*keys, *(F.ceil(F.col(c) / rows).cast("int").alias(b)
                            for c, b in (("__lefts", "__lb"), ("__rights", "__rb")))))

    def dealt(side: DataFrame, own: str, own_at: str, other: str, other_at: str, key: str) -> DataFrame:
        out = side.join(F.broadcast(hot), keys, "left")  # one key per ``rows`` of a side at most
        buckets = {c: F.coalesce(F.col(c), F.lit(1)) for c in (own, other)}
        return (out.withColumn(own_at, F.pmod(F.xxhash64(key), buckets[own]).cast("int"))
                .withColumn(other_at, F.explode(F.sequence(F.lit(0), buckets[other] - 1))).drop("__lb", "__rb"))

    lx = dealt(left, "__lb", "__l", "__rb", "__r", left_id)
    rx = dealt(right, "__rb", "__r", "__lb", "__l", right_id)
    if many_tasks:
        lx, rx = (x.repartition(tasks(left), *keys, "__l", "__r") for x in (lx, rx))
    return lx.join(rx, [*keys, "__l", "__r"]).where(condition).drop("__l", "__r")


# -- bounds -----------------------------------------------------------------------------------
def _unary_counts(name: Column, characters: str) -> Column:
    """Three bits per character: 0, 1, 11 or 111 for none, one, two or more than two of it."""
    total = F.lit(0).cast("long")
    for i, c in enumerate(characters):
        n = F.least(F.length(name) - F.length(F.replace(name, F.lit(c), F.lit(""))), F.lit(3))
        bits = F.element_at(F.array(*[F.lit(b).cast("long") for b in (0, 1, 3, 7)]), n + 1)
        total = total.bitwiseOR(F.shiftleft(bits, 3 * i))
    return total


def with_counts(df: DataFrame, name: str, prefix: str) -> DataFrame:
    half = len(COUNTED) // 2
    return df.withColumns({f"{prefix}a": _unary_counts(F.col(name), COUNTED[:half]),
                           f"{prefix}b": _unary_counts(F.col(name), COUNTED[half:])})


def _excess(p: str, q: str) -> Column:
    """Characters that the name of ``p`` has more of than that of ``q``."""
    return sum((F.bit_count(F.col(f"{p}{h}").bitwiseAND(F.bitwise_not(f"{q}{h}"))) for h in "ab"), F.lit(0))


def _limit(similarity: Column) -> Column:
    """The distance that a pair of lengths ``n`` and ``m`` may have at a similarity."""
    return F.floor((F.lit(1.0) - similarity) * F.greatest("n", "m") + _EPS).cast("int")


def _near(pairs_limit: Column) -> Column:
    return F.greatest(_excess("s", "r"), _excess("r", "s")) <= pairs_limit


def _scored(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Pairs whose distance is within ``limit``, with ``sim``."""
    found = pairs.withColumn("distance", F.expr("levenshtein(s, r, limit)")).where("distance >= 0")
    return found.select("s", "r", *keep, (F.lit(1.0) - F.col("distance") / F.greatest("n", "m")).alias("sim"))


# -- segment index ----------------------------------------------------------------------------
def _segments(right: DataFrame, rung: float) -> DataFrame:
    """``m, tau, i, seg`` of each register name, for every distance that a partner's length allows at ``rung``."""
    taus = F.expr(f"sequence(cast(floor({1 - rung}D * m + {_EPS}D) as int), cast(floor({1 - rung}D * floor(m / {rung}D + {_EPS}D) + {_EPS}D) as int))")
    cut = (right.withColumn("tau", F.explode(taus)).withColumn("i", F.explode(F.expr("sequence(0, tau)"))))
    return cut.withColumn("seg", F.expr(f"substring(r, {_START} + 1, {_LENGTH})"))


#: Segment i of m characters in tau + 1 even pieces, the longer ones last.
_START = "cast(i * (m div (tau + 1)) + greatest(0, i - (tau + 1 - m % (tau + 1))) as int)"
_LENGTH = "cast(m div (tau + 1) + if(i >= tau + 1 - m % (tau + 1), 1, 0) as int)"


def _lengths(left: DataFrame, rung: float) -> DataFrame:
    """``m``: the lengths that a name within ``rung`` may have."""
    lengths = F.expr(f"sequence(cast(ceil({rung}D * n - {_EPS}D) as int), cast(floor(n / {rung}D + {_EPS}D) as int))")
    return left.withColumn("m", F.explode(lengths)).where("m > 0")


def _substrings(left: DataFrame, rung: float) -> DataFrame:
    """``m, tau, i, seg``: the substrings of a supplier's name that a segment of a name of m characters can equal.

    If i errors lie before the segment, it is moved by i at most; if it is moved
    so far that more than tau - i lie behind it, an earlier segment is unchanged too.
    """
    at = left if "m" in left.columns else _lengths(left, rung)
    at = (at.withColumn("tau", F.expr(f"cast(floor({1 - rung}D * greatest(n, m) + {_EPS}D) as int)"))
          .withColumn("i", F.explode(F.expr("sequence(0, tau)"))))
    at = at.withColumns({"p": F.expr(_START), "len": F.expr(_LENGTH)}).withColumns({
        "lo": F.expr("greatest(0, p - i, p + n - m - (tau - i))"),
        "hi": F.expr("least(n - len, p + i, p + n - m + (tau - i))")}).where("lo <= hi")
    return (at.withColumn("at", F.explode(F.expr("sequence(lo, hi)")))
            .withColumn("seg", F.expr("substring(s, at + 1, len)")).drop("p", "len", "lo", "hi", "at"))


# -- digits -----------------------------------------------------------------------------------
def with_digits(df: DataFrame, name: str, digits: str) -> DataFrame:
    return df.withColumn(digits, F.regexp_replace(name, "[^0-9]", ""))


def _digit_class(digits: str) -> Column:
    return F.when(F.length(digits) >= MIN_DIGITS, F.length(digits)).otherwise(F.lit(-1))


def _left_over(length: str, other: Column, similarity: Column) -> Column:
    """The characters of a name of ``length`` that a pair at ``similarity`` may leave over, of lengths ``n`` and ``other``."""
    longer = F.greatest(F.col("n"), other)
    limit = F.floor((F.lit(1.0) - similarity) * longer + _EPS).cast("int")
    return limit - (longer - (other if length == "m" else F.col(length)))


def _may_meet(q: Column, u: Column, v: Column) -> Column:
    """Whether a name with the digits ``sd`` can have a partner of digit class ``q``."""
    p = F.length("sd")
    return (u >= 0) & (v >= 0) & F.when(q < 0, p - u < MIN_DIGITS).otherwise((p - u <= q) & (q - v <= p))


def _asked(left: DataFrame, classes: DataFrame, rung: float) -> DataFrame:
    """``m, q`` of the register's classes that hold a partner, and ``common``: the digits to meet by, null where that is by segments."""
    at = _lengths(left, rung).join(classes, "m")
    bound = F.greatest("t", F.lit(rung))
    at = at.withColumns({"u": _left_over("n", F.col("m"), bound), "v": _left_over("m", F.col("m"), bound), "p": F.length("sd")})
    at = at.where(_may_meet(F.col("q"), F.col("u"), F.col("v")))
    common = F.greatest(F.col("p") - F.col("u"), F.col("q") - F.col("v"))
    few = (F.col("q") >= 0) & (F.col("p") >= MIN_DIGITS) & (F.greatest("p", "q") - common <= MAX_LEFT_OUT)
    return at.withColumn("common", F.when(few, common)).drop("u", "v", "p")


def _shortened(digits: str, left_out: Column) -> Column:
    """The distinct texts that ``digits`` becomes without ``left_out`` of them."""
    texts = F.array(F.col(digits))
    found = F.when(left_out == 0, texts)
    for count in range(1, MAX_LEFT_OUT + 1):
        texts = F.array_distinct(F.flatten(F.transform(texts, lambda x: F.transform(
            F.sequence(F.lit(1), F.length(x)),
            lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))))
        found = found.when(left_out == count, texts)
    return found


def _by_digits(asked: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Pairs of ``asked`` and the register whose digits share a subsequence of ``common``."""
    keyed = asked.withColumn("part", F.explode(_shortened("sd", F.length("sd") - F.col("common"))))
    outs = asked.select("m", "q", (F.col("q") - F.col("common")).alias("out")).distinct()
    parts = (right.join(F.broadcast(outs), ["m", "q"])
             .withColumn("part", F.explode(_shortened("rd", F.col("out")))).drop("out", "rd"))
    return dealt_join(keyed.drop("common", "sd"), parts, ["m", "q", "part"], "s", "r", condition)


# -- whole classes ----------------------------------------------------------------------------
SEGMENT_KEYS = ["m", "q", "tau", "i", "seg"]


def with_lacking(df: DataFrame) -> DataFrame:
    """Adds ``lacks``: the digits that are not among ``sd``, empty for one only."""
    lacks = F.expr("translate('0123456789', sd, '')")
    return df.withColumn("lacks", F.when(F.length(lacks) > 1, lacks).otherwise(""))


def _by_cost(asked: DataFrame, right: DataFrame, rung: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The substrings of ``asked``, the segments that they look up, and the part of ``asked`` that would look up
    more rows than its classes have names: it is not among the substrings."""
    held = right.join(F.broadcast(asked.select("m", "q").distinct()), ["m", "q"])
    segments = _segments(held, rung)
    lists = segments.groupBy(*SEGMENT_KEYS).agg(F.count(F.lit(1)).alias("listed"))
    cost = (_substrings(asked.select("s", "n", "m", "q", "names"), rung).join(lists, SEGMENT_KEYS)
            .groupBy("s", "m", "q").agg((F.sum("listed") > F.first("names")).alias("dear")))
    asked = _cut(asked.join(cost, ["s", "m", "q"], "left").withColumn("dear", F.coalesce("dear", F.lit(False))))
    return _substrings(asked.where("NOT dear").drop("dear"), rung), segments, asked.where("dear").drop("dear")


def _scanned(asked: DataFrame, right: DataFrame, on: list[str], rx: list[str], k: int, within: Column, condition: Column) -> DataFrame:
    """Best ``k`` scored pairs of ``asked`` and all register names of its classes ``on``."""
    asked = asked.withColumn("lacks", F.when(F.col("q") >= 0, F.col("lacks")).otherwise(""))
    common = (asked.where("lacks <> ''").groupBy("lacks").agg(F.count(F.lit(1)).alias("asking"))
              .orderBy(F.desc("asking"), "lacks").limit(MAX_DIGIT_SETS).select("lacks", F.lit(True).alias("grouped")))
    asked = (asked.join(F.broadcast(common), "lacks", "left")
             .withColumn("lacks", F.when(F.col("grouped"), F.col("lacks")).otherwise("")).drop("grouped"))
    asked = _cut(asked)
    wanted = asked.select("lacks", *on).distinct()
    alike = Window.partitionBy("lacks", "like").orderBy("choice_ord", "r")
    groups = (right.join(F.broadcast(wanted), on)
              .withColumn("like", F.expr("translate(r, lacks, repeat(left(lacks, 1), length(lacks)))"))
              .withColumn("at", F.row_number().over(alike)).where(F.col("at") <= k))
    groups = _cut(groups)
    pairs = dealt_join(asked, groups.where("at = 1").drop("at"), ["lacks", *on], "s", "r", condition,
                       rows=SCANNED_PER_BUCKET, many_tasks=True)
    best = _best(_scored(pairs.withColumn("limit", within), [*rx, "lacks", "like"]), k)
    return best.select("s", "lacks", "like", "sim").join(groups.select("lacks", "like", "r", *rx), ["lacks", "like"]).select("s", "r", *rx, "sim")


# -- the search -------------------------------------------------------------------------------
def _bounded(names: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """``names`` with ``t``: the similarity of the k-th best known match, 0 with fewer."""
    worst = known.groupBy("s").agg(F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(0.0).alias("t"))
    return names.join(worst, "s", "left").withColumn("t", F.coalesce("t", F.lit(0.0)))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """Each supplier's best ``k`` of ``pairs``, which may come several times."""
    order = Window.partitionBy("s").orderBy(F.desc("sim"), F.asc("choice_ord"), F.asc("r"))
    return (pairs.withColumn("__at", F.dense_rank().over(order)).where(F.col("__at") <= k).drop("__at")
            .dropDuplicates(["s", "r"]))


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def best_pairs_by_edits(left: DataFrame, left_key: str, right: DataFrame, right_key: str, seeds: DataFrame, k: int = 5,
                        right_extra: tuple[str, ...] = ("choice_ord",), rungs: tuple[float, ...] = RUNGS) -> DataFrame:
    """Each left name's best ``k`` register names by edit distance, then ``choice_ord``: ``s, r, <right_extra>, sim``.

    ``seeds`` (``s, r, <right_extra>``) are pairs to begin with; they only save
    work.  Register names are unique; empty names have no matches.
    """
    rx = list(right_extra)
    L = left.select(F.col(left_key).alias("s")).where("s <> ''").distinct().withColumn("n", F.length("s"))
    R = right.select(F.col(right_key).alias("r"), *rx).where("r <> ''").withColumn("m", F.length("r"))
    L, R = with_digits(with_counts(L, "s", "s"), "s", "sd"), with_digits(with_counts(R, "r", "r"), "r", "rd")
    L, R = _cut(with_lacking(spread(L, "s"))), _cut(spread(R.withColumn("q", _digit_class("rd")), "r"))
    classes = R.groupBy("m", "q").agg(F.count(F.lit(1)).alias("names"))
    start = (seeds.select("s", "r", *rx).withColumn("n", F.length("s")).withColumn("m", F.length("r"))
             .withColumn("limit", F.greatest("n", "m")))
    known = _cut(_best(_scored(start, rx), k))
    open_names = _bounded(L, known, k)
    met = ["s", "r", *rx, "n", "m", "t"]
    for rung in rungs:
        within = _limit(F.greatest("t", F.lit(rung)))
        asked = _cut(_asked(open_names, classes, rung))
        substrings, segments, dear = _by_cost(asked.where("common IS NULL").drop("common", "sd"), R.drop("rd"), rung)
        by_segment = dealt_join(substrings.drop("names", "lacks"), segments, SEGMENT_KEYS, "s", "r", _near(within))
        by_digits = _by_digits(asked.where("common IS NOT NULL").drop("names", "lacks"), R, _near(within))
        pairs = by_segment.select(*met).unionByName(by_digits.select(*met))
        found = _scored(pairs.withColumn("limit", within), rx)
        scanned = _scanned(dear.drop("names"), R.drop("rd"), ["m", "q"], rx, k, within, _near(within))
        known = _cut(_best(known.unionByName(found).unionByName(scanned), k))
        open_names = _bounded(L, known, k).where(F.col("t") < rung)
    # Names short of k at the last rung: every length that their bound allows
    def length_class(length: str) -> str:
        return f"cast(floor({CLASSES_PER_DOUBLING} * log2(greatest({length}, 1)) + {_EPS}D) as int)"

    top = CLASSES_PER_DOUBLING * 31
    lengths = F.expr(f"sequence({length_class(f'floor(t * n)')}, least({top}, if(t > 0, {length_class('ceil(n / t)')}, {top})))")
    within = _limit(F.col("t"))
    held = classes.withColumn("c", F.expr(length_class("m"))).groupBy("c", "q").agg(F.collect_set("m").alias("ms"))
    some = F.exists("ms", lambda m: _may_meet(F.col("q"), _left_over("n", m, F.col("t")), _left_over("m", m, F.col("t"))))
    asked = open_names.withColumn("c", F.explode(lengths)).join(held, "c").where(some).drop("ms", "sd")
    near = (F.least("n", "m") >= F.col("t") * F.greatest("n", "m") - _EPS) & _near(within)
    scanned = _scanned(asked, R.withColumn("c", F.expr(length_class("m"))).drop("rd"), ["c", "q"], rx, k, within, near)
    return _best(known.unionByName(scanned), k)
