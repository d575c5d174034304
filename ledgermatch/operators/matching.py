"""Supplier-to-register matching: top-k most similar register names.

The reference scores every supplier against every register name (a nested
loop, suppliers x names scorer calls) and keeps the five best.  That does
not scale and is not expressible without a cross join, so matching here is a
*similarity join with a threshold*:

    pairs (s, r) whose token-set Jaccard similarity is at least ``t``,
    scored, and the best ``k`` per supplier kept
    (ties: higher score first, then register order ``choice_ord``).

The candidate generation is exact for that definition (prefix filtering by
pairs of tokens): tokens are ordered from rare to common, and two names that
must share o >= 2 tokens meet by a pair of tokens among their first few
(``_keyed``), so names which share only a common token (LTD, COMPANY, ...)
never meet.

Plan: explode tokens -> document frequency (aggregate) -> join frequency
back (AQE broadcasts it when small, splits hot tokens) -> per-name ordered
tokens -> keys per partner length -> equi-join on (key, lengths, buckets) ->
verify Jaccard, keep each pair at its first shared key -> score ->
``row_number`` per supplier (Spark pushes a partial top-k below the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .edit_distance import best_pairs_by_edits, dealt_join, spread

DEFAULT_MIN_SIMILARITY = 0.5
DEFAULT_K = 5
# A key that more names of one side may share is split into buckets of about so many.
ROWS_PER_SALT = 5000
# Of names with more tokens, the most common ones are indexed by subsets.
SUBSET_TOKENS = 10
_EPS = 1e-9


def processed(col: Column) -> Column:
    """Scorer pre-processing: non-alphanumerics to blanks, lower case, strip."""
    return F.trim(F.lower(F.regexp_replace(col, "[^A-Za-z0-9]", " ")))


def token_set(col: Column) -> Column:
    return F.array_distinct(F.filter(F.split(processed(col), " "), lambda x: x != ""))


def _tokenised(df: DataFrame, key: str, extra: list[str]) -> DataFrame:
    return (df.select(F.col(key).alias("name"), *extra)
            .withColumn("toks", token_set(F.col("name")))
            .filter(F.size("toks") > 0))


def _ordered(side: DataFrame, freq: DataFrame, extra: list[str]) -> DataFrame:
    """``ordered``: the name's tokens from rare to common, each with its number of names on either side."""
    ex = side.select("name", *extra, "toks", F.explode("toks").alias("tok"))
    return (ex.join(freq, "tok")
            .groupBy("name", *extra)
            .agg(F.array_sort(F.collect_list(F.struct("df", "tok", "lefts", "rights"))).alias("ordered"))
            .withColumn("toks", F.col("ordered.tok")).withColumn("n", F.size("toks")))


def _keyed(side: DataFrame, t: float) -> DataFrame:
    """``other, key, lefts, rights``: for each token count that a partner may have, the keys to meet it by.

    Partners of n and m tokens share o = ceil(t / (1 + t) * (n + m)) tokens at
    least.  Where o is one, every token is a key.  Else the two rarest shared
    tokens are among the first n - o + 2 of both names, so pairs of these are
    the keys.
    """
    lengths = side.withColumn("other", F.explode(F.expr(
        f"sequence(cast(ceil(n * {t}D - {_EPS}D) as int), cast(floor(n / {t}D + {_EPS}D) as int))")))
    overlap = lengths.withColumn("o", F.expr(f"cast(ceil({t}D / (1 + {t}D) * (n + other) - {_EPS}D) as int)"))
    pairs = """flatten(transform(slice(ordered, 1, n - o + 2), (x, i) -> transform(slice(ordered, i + 2, n - o + 1 - i),
        y -> struct(concat(x.tok, ' ', y.tok) AS key, least(x.lefts, y.lefts) AS lefts, least(x.rights, y.rights) AS rights))))"""
    keys = F.expr(f"CASE WHEN o = 1 THEN transform(ordered, x -> struct(x.tok AS key, x.lefts AS lefts, x.rights AS rights)) ELSE {pairs} END")
    return (overlap.withColumn("k", F.explode(keys)).select("*", "k.*").drop("k", "ordered")
            .where("lefts > 0 AND rights > 0"))


def candidate_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                    min_similarity: float = DEFAULT_MIN_SIMILARITY,
                    right_extra: tuple[str, ...] = ("choice_ord",)) -> DataFrame:
    """M4: every (left name, right name) pair with token Jaccard >= t.

    Returns s, r, <right_extra>, s_toks, r_toks, inter, jaccard.
    """
    t = float(min_similarity)
    if not 0.0 < t <= 1.0:
        raise ValueError("min_similarity must be in (0, 1]")
    rx = list(right_extra)
    L = _tokenised(left.select(left_key).distinct(), left_key, [])
    R = _tokenised(right, right_key, rx)
    freq = (L.select(F.explode("toks").alias("tok"), F.lit(1).alias("l"), F.lit(0).alias("r"))
            .unionByName(R.select(F.explode("toks").alias("tok"), F.lit(0).alias("l"), F.lit(1).alias("r")))
            .groupBy("tok").agg(F.count(F.lit(1)).alias("df"), F.sum("l").alias("lefts"), F.sum("r").alias("rights")))

    # A key's names are dealt to buckets on both sides, each side copied to the other's buckets.
    def buckets(names: str) -> Column:
        return F.ceil(F.col(names) / F.lit(ROWS_PER_SALT)).cast("int")

    def every(names: str) -> Column:
        return F.explode(F.sequence(F.lit(0), buckets(names) - 1))

    def own(names: str) -> Column:
        return F.pmod(F.xxhash64("name"), buckets(names)).cast("int")

    lx = (_keyed(_ordered(L, freq, []), t).withColumn("ls", own("lefts")).withColumn("rs", every("rights"))
          .select(F.col("name").alias("s"), F.col("toks").alias("s_toks"), F.col("n").alias("s_n"),
                  F.col("other").alias("r_n"), "key", "ls", "rs"))
    rk = (_keyed(_ordered(R, freq, rx), t).withColumn("rs", own("rights")).withColumn("ls", every("lefts"))
          .select(F.col("name").alias("r"), *rx, F.col("toks").alias("r_toks"), F.col("n").alias("r_n"),
                  F.col("other").alias("s_n"), "key", "ls", "rs"))
    shared = F.array_intersect("s_toks", "r_toks")  # rare to common
    joined = lx.join(rk, ["key", "s_n", "r_n", "ls", "rs"]).withColumn("inter", F.size(shared))
    jaccard = F.col("inter") / (F.col("s_n") + F.col("r_n") - F.col("inter"))
    # A pair meets at several keys; keep it at the first.
    first = F.array_join(F.slice(shared, F.lit(1), F.size(F.split("key", " "))), " ") == F.col("key")
    return (joined.withColumn("jaccard", jaccard).where((F.col("jaccard") >= F.lit(t)) & first)
            .select("s", "r", *rx, "s_toks", "r_toks", "inter", "jaccard"))


# -- scorers on candidate pairs (M2, M3) ----
def levenshtein_similarity(a: Column, b: Column) -> Column:
    """M2: 1 - edit distance / longer length (1.0 for two empty strings)."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b) / longest)


def token_sort_similarity(a: Column, b: Column) -> Column:
    """M3: Levenshtein similarity of the tokens in alphabetical order."""
    def in_order(x: Column) -> Column:
        return F.array_join(F.array_sort(F.filter(F.split(processed(x), " "), lambda t: t != "")), " ")
    return levenshtein_similarity(in_order(a), in_order(b))


def token_set_similarity(a: Column, b: Column) -> Column:
    """M3: best Levenshtein similarity among the shared tokens and the shared tokens followed by either rest."""
    x, y = token_set(a), token_set(b)
    both = F.array_sort(F.array_intersect(x, y))
    shared = F.array_join(both, " ")
    left = F.array_join(F.concat(both, F.array_sort(F.array_except(x, y))), " ")
    right = F.array_join(F.concat(both, F.array_sort(F.array_except(y, x))), " ")
    return F.greatest(levenshtein_similarity(shared, left), levenshtein_similarity(shared, right),
                      levenshtein_similarity(left, right))


def score_pairs(cands: DataFrame, scorer: str = "jaccard") -> DataFrame:
    """Add ``sim`` (unrounded, used for ranking) and ``score`` (0-100 int)."""
    if scorer == "jaccard":
        sim = F.col("jaccard")
    elif scorer == "levenshtein":
        sim = levenshtein_similarity(F.col("s"), F.col("r"))
    else:
        raise ValueError(f"unknown scorer {scorer!r}")
    return (cands.withColumn("sim", sim)
            .withColumn("score", F.round(F.col("sim") * F.lit(100.0)).cast("int")))


def _subsets(toks: Column) -> Column:
    """Every non-empty subset of a sorted token array, as text."""
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size(toks)).cast("int") - 1)
    return F.transform(masks, lambda m: F.array_join(F.filter(
        toks, lambda t, i: F.floor(m / F.pow(F.lit(2), i)) % 2 == 1), " "))


def best_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str, k: int = DEFAULT_K,
               right_extra: tuple[str, ...] = ("choice_ord",)) -> DataFrame:
    """Pairs that hold each left name's best ``k`` by token Jaccard, then ``choice_ord``; no threshold.

    A register name is indexed under every subset of its tokens, and of the
    names of one subset S and one length only the first ``k`` by ``choice_ord``
    stay.  A left name looks up its own subsets and keeps a pair where S is all
    that the two share.  Exact: let r, of b tokens, share just S with x.  The
    first k names of (S, b) share S at least, so none scores below r, and those
    that score the same come before it.  If r is not among them, k names beat
    it.  A left name meets ``k`` names per subset and length at most, whatever
    token is common.

    A name of more than ``SUBSET_TOKENS`` tokens is indexed by the subsets of
    its most common ones only (the proof holds for S among the indexed tokens of
    both).  Pairs that share a token which is not indexed for one of them, a
    rarer one of a long name, meet at that token, the first such one they share.
    """
    rx = list(right_extra)
    L = _tokenised(left.select(left_key).distinct(), left_key, []).select(
        F.col("name").alias("s"), F.array_sort("toks").alias("s_toks"), F.size("toks").alias("s_n"))
    R = _tokenised(right, right_key, rx).select(
        F.col("name").alias("r"), *rx, F.array_sort("toks").alias("r_toks"), F.size("toks").alias("r_n"))
    freq = (L.select(F.explode("s_toks").alias("tok")).unionByName(R.select(F.explode("r_toks").alias("tok")))
            .groupBy("tok").agg(F.count(F.lit(1)).alias("df")))
    L, R = spread(_with_common(L, "s", freq), "s"), _with_common(R, "r", freq)
    first = Window.partitionBy("sub", "r_n").orderBy("choice_ord", "r")
    index = (R.withColumn("sub", F.explode(_subsets(F.col("r_common"))))
             .withColumn("at", F.row_number().over(first)).where(F.col("at") <= k).drop("at"))
    asked = L.withColumn("sub", F.explode(_subsets(F.col("s_common"))))
    shared = F.array_intersect("s_toks", "r_toks")
    indexed = asked.join(index, "sub").where(F.array_join(shared, " ") == F.col("sub"))

    def tokens(side: DataFrame, p: str) -> DataFrame:
        out = side.withColumn("tok", F.explode(f"{p}_toks"))
        return out.withColumn(f"{p}_rare", ~F.array_contains(f"{p}_common", F.col("tok")))

    lt, rt = tokens(L, "s"), tokens(R, "r")
    rare = F.filter(shared, lambda x: ~(F.array_contains("s_common", x) & F.array_contains("r_common", x)))
    at_first = F.get(rare, F.lit(0)) == F.col("tok")
    met = (dealt_join(lt.where("s_rare"), rt, ["tok"], "s", "r", at_first)
           .unionByName(dealt_join(lt.where("NOT s_rare"), rt.where("r_rare"), ["tok"], "s", "r", at_first)))
    columns = ["s", "r", *rx, "s_toks", "r_toks", "s_n", "r_n"]
    pairs = indexed.select(*columns).unionByName(met.select(*columns)).withColumn("inter", F.size(shared))
    return (pairs.withColumn("jaccard", F.col("inter") / (F.col("s_n") + F.col("r_n") - F.col("inter")))
            .select("s", "r", *rx, "s_toks", "r_toks", "inter", "jaccard"))


def _with_common(side: DataFrame, p: str, freq: DataFrame) -> DataFrame:
    """Adds ``<p>_common``: the name's ``SUBSET_TOKENS`` most common tokens in alphabetical order, or all of fewer."""
    toks, size = f"{p}_toks", F.col(f"{p}_n")
    short = side.where(size <= SUBSET_TOKENS).withColumn(f"{p}_common", F.col(toks))
    long = side.where(size > SUBSET_TOKENS)
    ranked = (long.select(p, F.explode(toks).alias("tok")).join(freq, "tok").groupBy(p)
              .agg(F.array_sort(F.collect_list(F.struct((-F.col("df")).alias("order"), "tok"))).alias("ranked")))
    common = ranked.select(p, F.array_sort(F.slice("ranked", 1, SUBSET_TOKENS)["tok"]).alias(f"{p}_common"))
    return short.unionByName(long.join(common, p))


def top_k(scored: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Best ``k`` per supplier by unrounded similarity, then register order."""
    w = Window.partitionBy("s").orderBy(F.desc("sim"), F.asc("choice_ord"))
    return (scored.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def match_top_k(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                scorer: str = "jaccard", k: int = DEFAULT_K,
                min_similarity: float | None = None,
                match_type: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Long match table NORMALIZED_SUPPLIER, rank, match, score, choice_ord
    (plus match_type when given, plus register columns named in ``carry``).

    Without ``min_similarity`` the Jaccard scorer ranks all register names that
    share a token, the Levenshtein scorer all register names.  With it both rank
    the pairs of that token Jaccard and more.
    """
    extra = ("choice_ord", *carry)
    if min_similarity is not None:
        scored = score_pairs(candidate_pairs(left, left_key, right, right_key, min_similarity, right_extra=extra), scorer)
    else:
        scored = best_pairs(left, left_key, right, right_key, k, right_extra=extra)
        if scorer == "levenshtein":
            scored = best_pairs_by_edits(left, left_key, right, right_key, scored, k, right_extra=extra)
        scored = score_pairs(scored, scorer)
    best = top_k(scored, k)
    cols = [F.col("s").alias("NORMALIZED_SUPPLIER"), F.col("rank").cast("int").alias("rank"),
            F.col("r").alias("match"), "score", "choice_ord", *carry]
    if match_type is not None:
        cols.insert(0, F.lit(match_type).alias("match_type"))
    return best.select(*cols)


def exact_matches(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Suppliers whose normalised name equals a register name (score 100)."""
    l = left.select(F.col(left_key).alias("NORMALIZED_SUPPLIER")).distinct()
    r = right.select(F.col(right_key).alias("NORMALIZED_SUPPLIER"), "choice_ord")
    return l.join(r, "NORMALIZED_SUPPLIER").filter(F.col("NORMALIZED_SUPPLIER") != "")


def wide(long_matches: DataFrame, match_type: str, k: int = DEFAULT_K) -> DataFrame:
    """One row per supplier with best_<type>_match_<i> and ..._score columns
    for i = 1..k; missing ranks are null."""
    return by_rank(long_matches, match_type, {"": "match", "_score": "score"}, k)


def by_rank(long_matches: DataFrame, match_type: str, fields: dict[str, str], k: int = DEFAULT_K) -> DataFrame:
    """Per supplier ``best_<type>_match_<i><suffix>`` for i = 1..k and every suffix -> column of ``fields``.

    A supplier's ranks (``k`` at most) are collected and spread by one projection.
    """
    ranked = (long_matches.filter(F.col("rank").between(1, k)).groupBy("NORMALIZED_SUPPLIER")
              .agg(F.collect_list(F.struct("rank", *fields.values())).alias("found")))
    cols = []
    for i in range(1, k + 1):
        hit = F.get(F.filter("found", lambda m: m["rank"] == i), F.lit(0))
        for suffix, name in fields.items():
            value = hit[name].cast("double") if name == "score" else hit[name]
            cols.append(value.alias(f"best_{match_type}_match_{i}{suffix}"))
    return ranked.select("NORMALIZED_SUPPLIER", *cols)
