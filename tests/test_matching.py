"""Matching: the prefix-filtered join equals brute force; top-k ties; no threshold."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import matching as M

LEFT = ["ACME LTD", "ACME TRADING LTD", "BETA SERVICES", "GAMMA RAY LTD", "DELTA", "ACME",
        "ZETA ETA THETA", "LTD", "ALPHA BETA GAMMA DELTA", "OMEGA"]
RIGHT = ["ACME LTD", "ACME TRADING", "BETA SERVICES LTD", "GAMMA LTD", "DELTA LTD", "LTD",
         "ETA THETA ZETA", "ALPHA BETA GAMMA", "OMEGA LTD", "ACME HOLDINGS LTD", "RAY GAMMA LTD"]


def brute_force(t):
    out = {}
    for s, (i, r) in itertools.product(LEFT, enumerate(RIGHT)):
        a, b = set(s.lower().split()), set(r.lower().split())
        j = len(a & b) / len(a | b)
        if j >= t:
            out[(s, r)] = j
    return out


def frames(spark):
    left = spark.createDataFrame([(s,) for s in LEFT], "NORMALIZED_SUPPLIER string")
    right = spark.createDataFrame([(r, i) for i, r in enumerate(RIGHT)], "name string, choice_ord long")
    return left, right


def test_candidates_exact_against_brute_force(spark, monkeypatch):
    left, right = frames(spark)
    # Tiny salt buckets so the salted path is exercised too.
    monkeypatch.setattr(M, "ROWS_PER_SALT", 2)
    for t in (0.3, 0.5, 0.75, 1.0):
        got = {(r.s, r.r): r.jaccard for r in
               M.candidate_pairs(left, "NORMALIZED_SUPPLIER", right, "name", t).collect()}
        assert got == brute_force(t), t


def test_top_k_ties_by_register_order(spark):
    left, right = frames(spark)
    top = M.match_top_k(left, "NORMALIZED_SUPPLIER", right, "name", k=2, min_similarity=0.3)
    rows = {(r.NORMALIZED_SUPPLIER, r.rank): (r.match, r.choice_ord) for r in top.collect()}
    exp = {}
    bf = brute_force(0.3)
    for s in LEFT:
        ranked = sorted([(-j, RIGHT.index(r), r) for (s2, r), j in bf.items() if s2 == s])[:2]
        for k, (_, o, r) in enumerate(ranked, 1):
            exp[(s, k)] = (r, o)
    assert rows == exp


@pytest.mark.parametrize("subset_tokens", [10, 2])
def test_top_k_without_threshold_equals_all_pairs(spark, monkeypatch, subset_tokens):
    monkeypatch.setattr(M, "SUBSET_TOKENS", subset_tokens)  # 2: long names too
    rng = random.Random(3)
    words = ["LTD", "LTD", "CO", "ACME", "BETA", "RAY", "ZETA", "OMEGA", "DELTA"]
    names = sorted({" ".join(rng.sample(words, rng.randint(1, 5))) for _ in range(400)})
    rng.shuffle(names)
    left, right = names[:120], names[60:]
    top = M.match_top_k(spark.createDataFrame([(x,) for x in left], "NORMALIZED_SUPPLIER string"), "NORMALIZED_SUPPLIER",
                        spark.createDataFrame([(x, i) for i, x in enumerate(right)], "name string, choice_ord long"), "name")
    got = {(r.NORMALIZED_SUPPLIER, r.rank): r.choice_ord for r in top.collect()}
    want = {}
    for s in left:
        a = set(s.split())
        scored = [(-len(a & set(r.split())) / len(a | set(r.split())), i) for i, r in enumerate(right)]
        for k, (_, i) in enumerate(sorted(x for x in scored if x[0] < 0)[:5], 1):
            want[(s, k)] = i
    assert got == want


def test_common_token_does_not_join_all_names(spark):
    left = spark.range(3000).selectExpr("concat('X', id, ' LTD') AS NORMALIZED_SUPPLIER")
    right = spark.range(3000).selectExpr("concat('Y', id, ' LTD') AS name", "id AS choice_ord")
    assert M.best_pairs(left, "NORMALIZED_SUPPLIER", right, "name").count() == 3000 * 5
    assert M.candidate_pairs(left, "NORMALIZED_SUPPLIER", right, "name").count() == 0
    by_key = [M._keyed(M._ordered(M._tokenised(df, key, []), spark.sql("SELECT 'ltd' tok, 9 df, 9 lefts, 9 rights UNION ALL "
              "SELECT concat(x, id), 1, 1, 1 FROM range(3000), VALUES ('x'), ('y') AS t(x)"), []), 0.5)
              for df, key in ((left, "NORMALIZED_SUPPLIER"), (right, "name"))]
    assert by_key[0].where("n = other").join(by_key[1], "key").count() == 0  # LTD alone is no key


def test_long_names_that_share_common_tokens(spark):
    """5,000 names of 13 tokens with three in common do not all meet; the result is that of all pairs."""
    def name(side, i):
        return " ".join(["OF", "THE", "LTD", *(f"{side}{i}T{j}" for j in range(9)), f"Z{i % 700}"])

    left = [name("A", i) for i in range(2500)] + ["OF LTD", "Z3 OF"]
    right = [name("B", i) for i in range(2500)] + ["THE LTD OF Z5"]
    L = spark.createDataFrame([(x,) for x in left], "NORMALIZED_SUPPLIER string")
    R = spark.createDataFrame([(x, i) for i, x in enumerate(right)], "name string, choice_ord long")
    assert M.best_pairs(L, "NORMALIZED_SUPPLIER", R, "name").count() < 30 * len(left)
    got = {(r.NORMALIZED_SUPPLIER, r.rank): r.choice_ord for r in M.match_top_k(L, "NORMALIZED_SUPPLIER", R, "name").collect()}
    tokens = [set(x.split()) for x in right]
    for s in [*left[:40], *left[-3:]]:
        a = set(s.split())
        ranked = sorted((-len(a & b) / len(a | b), i) for i, b in enumerate(tokens) if a & b)[:5]
        assert [got[s, at] for at in range(1, len(ranked) + 1)] == [i for _, i in ranked], s


def test_token_sort_and_set(spark):
    row = spark.sql("SELECT 'ACME LTD' a, 'LTD ACME' b, 'ACME LTD NORTH' c").select(
        M.token_sort_similarity(F.col("a"), F.col("b")).alias("x"), M.token_set_similarity(F.col("a"), F.col("c")).alias("y"),
        M.token_sort_similarity(F.col("a"), F.col("c")).alias("z")).first()
    assert (row.x, row.y, round(row.z, 4)) == (1.0, 1.0, round(1 - 6 / 14, 4))


def test_no_cartesian_product_and_no_python_in_native_plan(spark):
    left, right = frames(spark)
    plan = M.match_top_k(left, "NORMALIZED_SUPPLIER", right, "name")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
