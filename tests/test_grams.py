"""Candidates by 3-grams equal all pairs; lists stay short; hot grams are dealt to buckets."""

import random
import string

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import edit_distance as E
from ledgermatch.operators import grams as G


def gram_set(name):
    padded = f"  {name} "
    return {padded[i:i + 3] for i in range(len(name) + 1)}


def frames(spark, left, right):
    return (spark.createDataFrame([(x,) for x in left], "NORMALIZED_SUPPLIER string").repartition(4),
            spark.createDataFrame([(x, i) for i, x in enumerate(right)], "name string, choice_ord long").repartition(4))


def misspelt(rng, word):
    at = rng.randrange(len(word))
    return word[:at] + rng.choice(string.ascii_uppercase) + word[at + rng.randint(0, 1):]


@pytest.mark.parametrize("t, bucket", [(0.3, 5000), (0.5, 4), (0.7, 5000), (1.0, 4)])
def test_candidates_equal_all_pairs(spark, monkeypatch, t, bucket):
    monkeypatch.setattr(E, "ROWS_PER_BUCKET", bucket)
    rng = random.Random(9)
    words = ["ACME", "ACMES", "BETA", "LTD", "LIMITED", "SERVICES", "AAAAAA", "Ø", "X"]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(160)})
    names += sorted({misspelt(rng, n) for n in names} - set(names))
    rng.shuffle(names)
    left, right = [*names[:140], ""], [*names[90:], ""]
    got = {(r.s, r.r): (r.inter, round(r.similarity, 9)) for r in
           G.candidate_pairs_by_grams(*frames(spark, left, right)[:1], "NORMALIZED_SUPPLIER", frames(spark, left, right)[1], "name", t).collect()}
    want = {}
    for s in left:
        for r in right:
            a, b = gram_set(s), gram_set(r)
            if s and r and len(a & b) >= (t - 1e-9) * len(a | b):
                want[s, r] = (len(a & b), round(len(a & b) / len(a | b), 9))
    assert got == want and len(want) >= 20


def test_one_word_names_join_few_rows(spark, monkeypatch):
    rng = random.Random(1)
    left = sorted({"".join(rng.choices(string.ascii_uppercase, k=rng.randint(7, 12))) + "LTD" for _ in range(5000)})
    right = [misspelt(rng, w) for w in left]
    joined = []

    def counting(*args, **options):
        out = E.dealt_join(*args[:5], F.lit(True), **options)
        joined.append(out.count())
        return out.where(args[5])

    monkeypatch.setattr(G, "dealt_join", counting)
    kept = G.candidate_pairs_by_grams(*frames(spark, left, right)[:1], "NORMALIZED_SUPPLIER", frames(spark, left, right)[1],
                                      "name", 0.6).count()
    assert kept >= 2500 and joined[0] < 60 * kept  # of 25,000,000 pairs, all with a common ending


def test_plan_has_no_product_and_no_python(spark):
    left, right = frames(spark, ["ACME"], ["ACME"])
    plan = G.candidate_pairs_by_grams(left, "NORMALIZED_SUPPLIER", right, "name")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    with pytest.raises(ValueError):
        G.candidate_pairs_by_grams(left, "NORMALIZED_SUPPLIER", right, "name", 0)


@pytest.mark.parametrize("t, hot", [(0.2, 1), (0.3, 3), (0.5, 1), (0.7, 1), (1.0, 1)])
def test_names_of_common_grams_equal_all_pairs(spark, monkeypatch, t, hot):
    monkeypatch.setattr(G, "HOT_NAMES", hot)
    rng = random.Random(2)
    names = sorted({"".join(rng.choices("AB", k=rng.randint(1, 7))) for _ in range(80)}
                   | {f"CUSTOMER{rng.randint(0, 300):05d}" + rng.choice(["", " LTD"]) for _ in range(80)})
    L, R = frames(spark, names[::2], names)
    got = {(r.s, r.r): r.inter for r in G.candidate_pairs_by_grams(L, "NORMALIZED_SUPPLIER", R, "name", t).collect()}
    grams = {n: gram_set(n) for n in names}
    assert got == {(s, r): len(grams[s] & grams[r]) for s in names[::2] for r in names
                   if len(grams[s] & grams[r]) >= (t - 1e-9) * len(grams[s] | grams[r])}


def test_numbered_names_join_few_rows(spark, monkeypatch):
    left = [f"CUSTOMER{i:09d}" for i in range(2000)]
    right = [f"CUSTOMER{i:09d} {end}" for i in range(2000) for end in ("LTD", "HOLDINGS")]
    L, R = frames(spark, left, right)
    joined = []

    def counting(*args, **options):
        out = E.dealt_join(*args[:5], F.lit(True), **options)
        joined.append(out.count())
        return out.where(args[5])

    monkeypatch.setattr(G, "dealt_join", counting)
    kept = G.candidate_pairs_by_grams(L, "NORMALIZED_SUPPLIER", R, "name").count()
    assert kept >= len(left) and joined[0] < 100 * len(left)


def test_names_without_a_partner_of_their_size_are_not_listed(spark, monkeypatch):
    """Grams that no name of a fitting size holds cannot be shared; pairs that only share a key do not leave the join."""
    left = [f"CUSTOMER{i:09d}" for i in range(3000)]
    right = [f"CUSTOMER{i:09d} {end}" for i in range(3000) for end in ("LTD", "HOLDINGS")]
    L, R = frames(spark, [*left, "COLD RING PROMO BRAND12 COMPANY"], right)
    listed, met = [], []

    def counting(*args, **options):
        out = E.dealt_join(*args, **options)
        listed.extend(side.count() for side in args[:2])
        met.append(out.count())
        return out

    monkeypatch.setattr(G, "dealt_join", counting)
    got = {(r.s, r.r) for r in G.candidate_pairs_by_grams(L, "NORMALIZED_SUPPLIER", R, "name").collect()}
    assert {(s, f"{s} LTD") for s in left} <= got and len(got) < 2 * len(left)
    assert listed[0] < 12 * len(left) and listed[1] < 30 * len(left)  # no list entry of the 3,000 long names
    assert met[0] < 12 * len(left)
