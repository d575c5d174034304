"""Cleaning in one pass: each step once, with the results of the plain functions."""

import itertools
import random

from pyspark.sql import functions as F

from ledgermatch.functions import dates as D
from ledgermatch.functions import text as T
from ledgermatch.functions.normalise import WS_CLASS, normalise_frame, plain_short
from ledgermatch.operators import payments as PM


def union(spark, rows):
    df = spark.createDataFrame(rows, "SUPPLIER string, date string, amount double, dept string, k1 long")
    return df.select("SUPPLIER", "date", "amount", "dept", F.struct(F.lit(1).cast("long").alias("feed_ord"), "k1").alias("row_ord"))


def test_mixed_dates_of_a_frame_equal_the_column(spark):
    rng = random.Random(3)
    days = ["1", "01", "31", "30", "00", "32", "29", "13"]
    months = ["1", "02", "12", "13", "00", "Feb", "feb", "SEPT", "Sep", "September", "MAY", "May", "Juneau", "é"]
    years = ["2020", "2019", "20", "70", "69", "0000", "0001", "1900", "20201", ""]
    texts = [None, "", "T", "20200229", "20190229", "2020", "0000", "1 Oct 2020\n", "March 5, 2019", "n/a 2020", " 1/2/2020 ", "1/2", "1-Oct"]
    for d, m, y in itertools.product(days, months, years):
        mark = rng.choice(["/", "-", ".", " ", ", ", "/-"])
        parts = rng.choice([(d, m, y), (m, d, y), (y, m, d)])
        texts.append(mark.join(parts) + rng.choice(["", "", "T00:00:00", " 10:30", " 10:30:15.250", " 10:30 PM", ":"]))
    df = spark.createDataFrame([(x,) for x in texts], "d string")
    out = D.with_mixed_date(df, "d", "x")
    assert out.columns == ["d", "x"]
    rows = out.withColumn("want", D.parse_mixed_date(F.col("d"))).select("d", F.col("x").cast("string"), F.col("want").cast("string")).collect()
    assert [(r.d, r.x) for r in rows] == [(r.d, r.want) for r in rows] and sum(r.want is not None for r in rows) > 150


def test_numbers_of_dates_are_split_without_a_pattern(spark):
    df = spark.createDataFrame([("1/2.2020",), ("2020-1/2",), ("31.12-69",)], "d string")
    out = D.with_mixed_date(df, "d", "x")
    assert [str(r.x) for r in out.collect()] == ["2020-01-02", "2020-01-02", "2069-12-31"]
    assert "split(" in (plan := out._jdf.queryExecution().optimizedPlan().toString()) and ", [-./], -1)" not in plan


def test_ampersands_without_a_semicolon_stay(spark):
    texts = {"Tom & Co": "Tom & Co", "A &amp B": "A &amp B", "A &amp; B": "A & B", "<b>A</b> & B": "A & B", ";&": ";&", "<i>&lt;": "<"}
    rows = spark.createDataFrame([(x,) for x in texts], "s string").withColumn("t", T.strip_html(F.col("s"))).collect()
    assert {r.s: r.t for r in rows} == texts


def test_strip_and_org_columns_equal_the_plain_forms(spark):
    texts = ["\u3000 a\x85", "\xa0\u2009\u2009", "x\u200b", "\x1cB\x1f", "", None, " a b ", "A,B", "Acme Ltd, ACME LTD", "AB, CDE ,FGHI", "a,,b",
             "ACME,\xa0INC\u2028", ","]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    plain = F.regexp_replace("s", rf"^{WS_CLASS}+|{WS_CLASS}+\z", "")
    rows = T.with_org(df, "s", "a", "n").withColumns({"o": T.org_counter(F.col("s")), "t": T.py_strip(F.col("s")), "want": plain}).collect()
    assert all(r.t == r.want for r in rows)
    assert all((r.a, r.n) == (r.o["name"], r.o["n"]) for r in rows if r.s is not None)


def test_short_names_that_no_step_changes(spark):
    signs = "AOFNCTHESPLIMD019&'. "
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(signs, repeat=n)]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    rows = normalise_frame(df, "s", "n").withColumn("plain", F.expr(plain_short("s"))).where("plain").collect()
    assert len(rows) > 2000 and all(r.n == r.s for r in rows)


def test_clean_rows_compute_each_step_once(spark):
    rows = [("<b>Acme</b> &amp; Sons", "1/2/2020", 1.0, "A", 1), ("AB", "1/2/2020", 1.0, "A", 2), ("ca", "1 Oct 2020", 2.0, "A", 3),
            (None, "2020", 1.0, "A", 4), ("12", "2020", 1.0, "A", 5), ("Acme", "n/a", 1.0, "A", 6), ("X LTD, Y LTD", "2020", 1.0, "A", 7),
            ("please see list", "2020", 1.0, "A", 8), ("ACME", "2020", None, "A", 9), ("ACME", "2020", 1.0, None, 10)]
    pay = union(spark, rows)
    reasons = {r.row_ord.k1: r.drop_reason for r in PM.annotate(pay).collect()}
    assert reasons == {1: None, 2: "short_name", 3: None, 4: "null_supplier", 5: "numeric_supplier", 6: "null_date", 7: "multi_org",
                       8: "redacted", 9: "null_amount", 10: "null_dept"}
    plan = PM.clean(pay)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SEE ATTACH") == 1 and plan.count("<(script|style)") == 1


def test_output_names_from_all_payments_equal_those_of_clean_rows(spark):
    pay = union(spark, [("Acme &amp; Co Ltd", "2020", 1.0, "A", 1), ("acme & co ltd", "2020", 1.0, "A", 2), (None, "2020", 1.0, "A", 3),
                        ("Beta Limited", None, 1.0, "A", 4), ("BETA LIMITED", "2020", 1.0, "A", 5), ("77", "2020", 1.0, "A", 6)])
    got = PM.payments_output(PM.clean(pay), payments=pay).select("row_ord.k1", "SUPPLIER", "NORMALIZED_SUPPLIER")
    want = PM.payments_output(PM.clean(pay)).select("row_ord.k1", "SUPPLIER", "NORMALIZED_SUPPLIER")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 3


def test_feeds_run_without_methods_that_the_jvm_leaves_interpreted(spark):
    from ledgermatch.session import with_small_methods

    with_small_methods(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_dates_of_a_feed_need_no_lambda_no_title_case_and_no_calendar_arithmetic(spark):
    texts = ["13/02/2020", "02/13/2020", "31/12/69", "00/12/2020", "12/00/2020", "5 ſep 2020", "5 Auguſt 2020", "JAN 05, 20", "5 Jan 0000", "0000-01-05",
             "01/02/0000", "5-Jan -70", "5 Jan 020", "2020-13-01", "2020", "20200230", "2020-2-3", "2020.02/03"]
    df = spark.createDataFrame([(x,) for x in texts], "d string")
    out = D.with_mixed_date(df, "d", "x")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "initcap" not in plan and "last_day" not in plan
    assert {r.d: r.x and str(r.x) for r in out.select("d", F.col("x").cast("string")).collect()} == {
        "13/02/2020": "2020-02-13", "02/13/2020": "2020-02-13", "31/12/69": "2069-12-31", "00/12/2020": None, "12/00/2020": None,
        "5 ſep 2020": "2020-09-05", "5 Auguſt 2020": None, "JAN 05, 20": "2020-01-05", "5 Jan 0000": "0000-01-05", "0000-01-05": None,
        "01/02/0000": None, "5-Jan -70": "1970-01-05", "5 Jan 020": None, "2020-13-01": None, "2020": "2020-01-01", "20200230": None,
        "2020-2-3": "2020-02-03", "2020.02/03": "2020-02-03"}


def test_rows_without_a_needed_value_are_not_cleaned(spark):
    pay = union(spark, [("Acme", "2020", 1.0, "A", 1), (None, "2020", 1.0, "A", 2), ("Acme", None, 1.0, "A", 3), ("Acme", "2020", None, "A", 4),
                        ("Acme", "2020", 1.0, None, 5), ("Acme", "2020", float("nan"), "A", 6)])
    out = PM.clean(pay)
    assert sorted(r.row_ord.k1 for r in out.collect()) == [1, 6]
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = {x: next(i for i, line in enumerate(plan) if x in line) for x in ("isnotnull(amount", "__pay_date_shape")}
    assert at["isnotnull(amount"] > at["__pay_date_shape"]
