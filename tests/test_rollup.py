"""Roll-up by hash aggregates, positions packed in one number, score distributions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import payments, review, suppliers

ORD = "row_ord struct<feed_ord: bigint, k1: bigint, k2: bigint, k3: bigint, k4: bigint>"


def test_packed_positions_keep_the_order(spark):
    rnd = random.Random(5)
    top = [10 ** payments.ORD_DIGITS[k] - 1 for k in payments.ORD_KEYS]
    rows = [tuple(rnd.choice([0, 1, t, rnd.randint(0, t)]) for t in top) for _ in range(400)]
    df = spark.createDataFrame([(r,) for r in rows], ORD)
    got = df.select("row_ord", payments.packed_ord("row_ord").alias("p")).collect()
    assert [tuple(r.row_ord) for r in sorted(got, key=lambda r: r.p)] == sorted(rows)
    assert len({r.p for r in got}) == len(set(rows))


@pytest.mark.parametrize("bad", [(0, 0, 100, 0, 0), (0, -1, 0, 0, 0), (10, 0, 0, 0, 0), (0, 0, 0, None, 0)])
def test_a_position_out_of_range_is_an_error(spark, bad):
    df = spark.createDataFrame([(bad,)], ORD)
    with pytest.raises(Exception, match="out of range"):
        df.select(payments.packed_ord("row_ord").alias("p")).collect()


def test_rollup_lists_by_first_position_without_a_sort_aggregate(spark):
    rnd = random.Random(6)
    rows = [(f"S{rnd.randint(0, 5)}", rnd.choice(["A", "B", "C", None]), rnd.choice(["N", None]), rnd.choice([True, False, None]),
             float(rnd.randint(1, 9)), dt.date(2020, 1, rnd.randint(1, 9)), (rnd.randint(0, 2), rnd.randint(0, 9), 0, i, 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "SUPPLIER string, dept string, contractsfinder_region string, contractsfinder_awardedToVcse boolean, "
                                     "amount double, pay_date date, " + ORD)
    out = suppliers.rollup(df)
    assert "SortAggregate" not in out._jdf.queryExecution().toString()
    for r in out.collect():
        own = sorted((x for x in rows if x[0] == r.SUPPLIER), key=lambda x: x[6])
        assert r.dept == list(dict.fromkeys(x[1] for x in own)) and r.region == list(dict.fromkeys(x[2] for x in own))
        assert (r.PAYMENT_TOTAL_COUNT, r.PAYMENT_TOTAL_AMOUNT) == (len(own), sum(x[4] for x in own))


def matches(spark, scores):
    rows = [("ch", f"S{i}", k + 1, f"R{i}.{k}", s) for i, own in enumerate(scores) for k, s in enumerate(own)]
    return spark.createDataFrame(rows, "match_type string, NORMALIZED_SUPPLIER string, rank int, match string, score int")


def test_histogram_buckets_and_margins(spark):
    got = review.match_histogram(matches(spark, [[100, 40], [100], [95, 95], [99, 90], [9], [10, 0, 0]])).collect()
    assert {r.bucket: (r.n_suppliers, r.n_alone, r.min_margin, r.max_margin, r.avg_margin) for r in got} == {
        11: (2, 1, 60, 100, 80.0), 10: (2, 0, 0, 9, 4.5), 1: (1, 1, 9, 9, 9.0), 2: (1, 0, 10, 10, 10.0)}
    assert review.match_histogram(matches(spark, [[100]]).limit(0)).collect() == []


def test_sketches_of_parts_merge_to_quantiles(spark):
    values = [(i * 37) % 101 for i in range(20000)]
    long = matches(spark, [[v] for v in values])
    halves = [review.score_sketches(long.filter(F.crc32("match") % 2 == h)) for h in (0, 1)]
    row = review.score_quantiles(halves[0].unionByName(halves[1]), [0.1, 0.5, 0.9]).first()
    assert (row.match_type, row.n) == ("ch", len(values))
    for want, got in zip((0.1, 0.5, 0.9), row.quantiles):
        below = sum(v < got for v in values) / len(values)
        upto = sum(v <= got for v in values) / len(values)
        assert below - 0.02 <= want <= upto + 0.02


def test_wide_keeps_missing_ranks_null(spark):
    row = review.wide_with_names(matches(spark, [[90, 80]]).withColumn("notnormalised", F.lower("match")), "ch").first()
    assert (row.best_ch_match_1, row.best_ch_match_1_score, row.best_ch_match_2_notnormalised) == ("R0.0", 90.0, "r0.1")
    assert row.best_ch_match_3 is None and row.best_ch_match_3_score is None
