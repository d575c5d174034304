"""Best matches by edit distance equal a search over all pairs; the segment index alone is complete at its similarity."""

import random

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import edit_distance as E
from ledgermatch.operators import matching as M


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def names(rng, count):
    words = ["ACME", "BETA", "TRADING", "LTD", "LTD", "SERVICES", "OF", "LEEDS", "COUNCIL", "Café", "ÆON", "x", "NHS", "24"]

    def name():
        text = " ".join(rng.choices(words, k=rng.randint(1, 5)))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(["", "", "Q", "7", " ", "É"]) + text[at + rng.randint(0, 1):]
        return text
    return sorted({n for n in (name() for _ in range(count)) if n})


def frames(spark, left, right):
    return (spark.createDataFrame([(x,) for x in left], "NORMALIZED_SUPPLIER string").repartition(3),
            spark.createDataFrame([(x, i) for i, x in enumerate(right)], "name string, choice_ord long").repartition(3))


def all_pairs(left, right, k=5):
    out = {}
    for s in left:
        ranked = sorted((-(1.0 - distance(s, r) / max(len(s), len(r))), i) for i, r in enumerate(right))[:k]
        out.update({(s, at): i for at, (_, i) in enumerate(ranked, 1)})
    return out


@pytest.mark.parametrize("bucket, rungs", [(5000, E.RUNGS), (7, (0.9, 0.8, 0.6)), (3, ())])
def test_top_five_equal_all_pairs(spark, monkeypatch, bucket, rungs):
    monkeypatch.setattr(E, "ROWS_PER_BUCKET", bucket)
    monkeypatch.setattr(E.best_pairs_by_edits, "__defaults__", (5, ("choice_ord",), rungs))
    rng = random.Random(bucket)
    left, right = names(rng, 90), names(rng, 140)
    rng.shuffle(right)
    got = M.match_top_k(*frames(spark, [*left, "", "A", "ACMELTD"], [*right, "", "B"])[:1], "NORMALIZED_SUPPLIER",
                        frames(spark, left, [*right, "", "B"])[1], "name", scorer="levenshtein")
    got = {(r.NORMALIZED_SUPPLIER, r.rank): r.choice_ord for r in got.collect()}
    want = all_pairs([*left, "A", "ACMELTD"], [*right, "B"])
    last = len(right) + 1
    want = {key: last if i == len(right) else i for key, i in want.items()}  # the empty name takes a number, but no match
    assert got == want


@pytest.mark.parametrize("rung", [0.9, 0.8, 0.6])
def test_segments_miss_no_pair(spark, rung):
    """Every pair within the rung's distance shares a segment; checked without seeds and without the last step."""
    rng = random.Random(5)
    left, right = names(rng, 150), names(rng, 150)
    L, R = frames(spark, left, right)
    L = L.select(F.col("NORMALIZED_SUPPLIER").alias("s")).withColumn("n", F.length("s")).withColumn("t", F.lit(0.0))
    R = R.select(F.col("name").alias("r"), "choice_ord").withColumn("m", F.length("r"))
    met = {(r.s, r.r) for r in E._substrings(L, rung).join(E._segments(R, rung), ["m", "tau", "i", "seg"]).select("s", "r").collect()}
    close = {(s, r) for s in left for r in right if distance(s, r) <= int((1 - rung) * max(len(s), len(r)) + 1e-9)}
    assert close and close <= met


def test_character_counts_bound_the_distance(spark):
    rng = random.Random(6)
    left, right = names(rng, 60), names(rng, 60)
    L, R = frames(spark, left, right)
    pairs = (E.with_counts(L.select(F.col("NORMALIZED_SUPPLIER").alias("s")), "s", "s")
             .crossJoin(E.with_counts(R.select(F.col("name").alias("r")), "r", "r")))
    rows = pairs.select("s", "r", F.greatest(E._excess("s", "r"), E._excess("r", "s")).alias("bound")).collect()
    assert all(r.bound <= distance(r.s, r.r) for r in rows) and sum(r.bound > 5 for r in rows) > 100


def test_dealt_join_meets_every_pair_once(spark):
    left = spark.range(300).selectExpr("id AS a", "if(id < 250, 0, id) AS k")
    right = spark.range(200).selectExpr("id AS b", "if(id < 180, 0, id + 80) AS k")
    got = E.dealt_join(left, right, ["k"], "a", "b", F.lit(True), rows=16).select("a", "b")
    want = left.join(right, "k").select("a", "b")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() > 250 * 180


def test_typo_in_a_single_word_is_found(spark):
    left, right = frames(spark, ["GREGGSS"], ["ALPHA", "GREGGS", "BETA LTD", "GREGS LTD"])
    rows = M.match_top_k(left, "NORMALIZED_SUPPLIER", right, "name", scorer="levenshtein").orderBy("rank").collect()
    assert [r.match for r in rows][:2] == ["GREGGS", "GREGS LTD"] and len(rows) == 4
    plan = M.match_top_k(left, "NORMALIZED_SUPPLIER", right, "name", scorer="levenshtein")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def numbered(rng, count):
    """Names whose numbers of 5 to 9 digits differ by a few digits, swapped, missing or among letters."""
    def name():
        number = str(rng.randint(0, 300)).zfill(rng.choice([5, 6, 7, 9]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(number))
            number = number[:at] + rng.choice(["", "7", "Q", " "]) + number[at + rng.randint(0, 1):]
        return rng.choice(["", "CUSTOMER ", "A"]) + number + rng.choice(["", "", " LTD", " HOLDINGS"])
    return sorted({name() for _ in range(count)})


@pytest.mark.parametrize("bucket, rungs", [(5000, E.RUNGS), (7, (0.9, 0.6, 0.4)), (3, ())])
def test_names_with_numbers_equal_all_pairs(spark, monkeypatch, bucket, rungs):
    monkeypatch.setattr(E, "ROWS_PER_BUCKET", bucket)
    monkeypatch.setattr(E.best_pairs_by_edits, "__defaults__", (5, ("choice_ord",), rungs))
    rng = random.Random(bucket)
    left, right = numbered(rng, 80) + names(rng, 20), numbered(rng, 150) + names(rng, 20)
    rng.shuffle(right)
    L, R = frames(spark, left, right)
    got = M.match_top_k(L, "NORMALIZED_SUPPLIER", R, "name", scorer="levenshtein")
    assert {(r.NORMALIZED_SUPPLIER, r.rank): r.choice_ord for r in got.collect()} == all_pairs(left, right)


def test_names_that_differ_by_digits_join_few_rows(spark, monkeypatch):
    left = [f"CUSTOMER {i:09d}" for i in range(2000)]
    right = [f"CUSTOMER {i:09d} {end}" for i in range(2000) for end in ("LTD", "HOLDINGS")]
    joined, dealt = [], E.dealt_join

    def counting(*args, **options):
        out = dealt(*args[:5], F.lit(True), **options)
        joined.append(out.count())
        return out.where(args[5])

    L, R = frames(spark, left, right)
    seeds = M.best_pairs(L, "NORMALIZED_SUPPLIER", R, "name")
    monkeypatch.setattr(E, "dealt_join", counting)
    rows = E.best_pairs_by_edits(L, "NORMALIZED_SUPPLIER", R, "name", seeds).where("s = 'CUSTOMER 000001234'").collect()
    assert max(rows, key=lambda r: r.sim).r == "CUSTOMER 000001234 LTD" and len(rows) == 5
    assert sum(joined) < 300 * len(left)  # of 8,000,000 pairs


def counted(monkeypatch):
    joined, dealt = [], E.dealt_join

    def counting(*args, **options):
        out = dealt(*args[:5], F.lit(True), **options)
        joined.append(out.count())
        return out.where(args[5])

    monkeypatch.setattr(E, "dealt_join", counting)
    return joined


def test_names_without_numbers_meet_groups_of_numbered_names(spark, monkeypatch):
    """Names that differ only in digits which a supplier lacks are one group to it; its first names count."""
    left = ["OLD GEAR PROMO BRAND4 LTD", "NEW ROD SMALL BRAND12", "TOM MERTON", "0 HOLDINGS", "CUSTOMER 7"]
    right = [f"CUSTOMER{i:09d} {end}" for i in range(1500) for end in ("LTD", "HOLDINGS")] + ["OLD GEAR", "NEW RODS"]
    random.Random(4).shuffle(right)
    L, R = frames(spark, left, right)
    joined = counted(monkeypatch)
    got = M.match_top_k(L, "NORMALIZED_SUPPLIER", R, "name", scorer="levenshtein")
    assert {(r.NORMALIZED_SUPPLIER, r.rank): r.choice_ord for r in got.collect()} == all_pairs(left, right)
    joined_by_edits = sum(joined[2:])  # behind the two joins of the seeds
    assert joined_by_edits < 200 * len(left)  # of 15,000 pairs


def test_names_of_common_words_meet_once(spark, monkeypatch):
    """Segments that most names hold would bring each pair several times; its names meet as a class."""
    words = [("OLD", "NEW", "RED", "HOT"), ("GEAR", "BOLT", "RING"), ("PROMO", "SMALL"), ("BRAND1", "BRAND2", "BRAND3", "BRAND4")]
    right = [" ".join((a, b, c, d)) for a in words[0] for b in words[1] for c in words[2] for d in words[3]]
    left = [f"{name} LTD" for name in right]
    L, R = frames(spark, left, [f"{name} PLC" for name in right])
    seeds = M.best_pairs(L, "NORMALIZED_SUPPLIER", R, "name")
    joined = counted(monkeypatch)
    rows = E.best_pairs_by_edits(L, "NORMALIZED_SUPPLIER", R, "name", seeds).collect()
    want = all_pairs(left, [f"{name} PLC" for name in right])
    assert {(r.s, r.choice_ord) for r in rows} == {(s, i) for (s, _), i in want.items()}
    assert sum(joined) < 2.5 * len(left) * len(right)
