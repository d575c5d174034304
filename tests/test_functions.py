"""Scalar functions: organisation counter, numeric test, dates, HTML."""

import datetime as dt

from pyspark.sql import functions as F

from ledgermatch.functions import dates as D
from ledgermatch.functions import text as T


def test_org_counter(spark):
    cases = [("Acme Ltd, ACME LTD", "ACME LTD", 1), ("ACME, INC", "ACME", 1), ("A,B", "A,B", 0),
             ("ACME LTD, BETA LTD", "ACME LTD, BETA LTD", 2), ("acme", "ACME", 1)]
    df = spark.createDataFrame([(c[0],) for c in cases], "s string")
    got = df.select("s", T.org_counter(F.col("s")).alias("o")).collect()
    assert [(r.o["name"], r.o["n"]) for r in got] == [(c[1], c[2]) for c in cases]


def test_numeric_text(spark):
    numeric = ["INF", "INFINITY", "1E5", " 12 ", "+5", ".5", "5."]
    not_numeric = ["NAN", "123D", "0X10", "1_000", "1,000", "3M"]
    df = spark.createDataFrame([(x,) for x in numeric + not_numeric], "s string")
    got = [r.n for r in df.select(T.is_numeric_text(F.col("s")).alias("n")).collect()]
    assert got == [True] * len(numeric) + [False] * len(not_numeric)


def test_payment_dates(spark):
    cases = [("01/02/2020", "02-01-2020"), ("13/02/2020", "13-02-2020"),
             ("2020-02-01T00:00:00Z", "01-02-2020"), ("20200201", "01-02-2020"),
             ("1 OCT 2020", None), ("43831", None), ("1 Oct 2020", "01-10-2020"), ("03-Feb-21", "03-02-2021"),
             ("31/03/2020 00:00", "31-03-2020"), ("2020-03-31 10:30", "31-03-2020"),
             ("2020-03-31 10:30:15.250", "31-03-2020"), ("03/02/99", "02-03-1999"), ("31.12.2020", "31-12-2020"),
             ("March 5, 2019", "05-03-2019"), ("5 MARCH 2019", "05-03-2019"), ("2020", "01-01-2020"), ("n/a 2020", None),
             ("30/02/2020", None), ("29/02/2020", "29-02-2020"), ("29-02-2019", None), ("2020/13/01", None), ("00/00/2020", None),
             ("20201301", None), ("1/2/20201", None), ("99/99/99", None), ("", None), (None, None), ("31/12/69", "31-12-2069")]
    df = spark.createDataFrame([(c[0],) for c in cases], "d string")
    got = [r.o for r in df.select(D.fmt_dmy(D.parse_mixed_date(F.col("d"))).alias("o")).collect()]
    assert got == [c[1] for c in cases]


def test_parse_ymd(spark):
    cases = [("2020/03/01", "2020-03-01"), ("2020/3/1", "2020-03-01"), ("25/05/01", None), ("2020/02/30", None), ("2020/13/01", None),
             ("2020/3/1 ", None), ("20/3/2001", None), ("2020-03-01", None), ("12020/03/01", None), ("", None), (None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "d string")
    got = [None if r.o is None else r.o.isoformat() for r in df.select(D.parse_ymd(F.col("d")).alias("o")).collect()]
    assert got == [c[1] for c in cases]


def test_register_dates_and_asof(spark):
    from ledgermatch.operators.registers import closed_by
    cases = [("31/12/2009", True), (None, False), ("01/01/2010", True), ("02/01/2010", False)]
    df = spark.createDataFrame(cases, "d string, exp boolean")
    got = df.select("exp", closed_by(D.parse_dayfirst_date(F.col("d"))).alias("c")).collect()
    assert all(r.c == r.exp for r in got)


def test_date_range(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 1), dt.date(2019, 1, 3)), (dt.date(2020, 2, 1), None),
                                (None, None)], "a date, b date")
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    got = [r.o for r in df.select(D.date_range_text(lo, hi).alias("o")).collect()]
    assert got == ["03-01-2019-01-02-2020", "01-02-2020", ""]


def test_strip_html(spark):
    df = spark.createDataFrame([("<B>ACME</B> &AMP; SONS",), ("A <script>x</script>B<!-- c -->",),
                                ("&amp;lt;",), ("O&#39;NEIL &#X26;amp; &#8364; &amp;#39; &#55296;",), ("PLAIN",), (None,)], "s string")
    got = [r.o for r in df.select(T.strip_html(F.col("s")).alias("o")).collect()]
    assert got == ["ACME & SONS", "A B", "&lt;", "O'NEIL &amp; \u20ac &#39; \ufffd", "PLAIN", None]


HTML_CASES = [
    ('<a title="x>y">in</a> out', "in out"), ("<a title='a>b\"c' href=x>in</a>", "in"), ("caf&eacute; &Eacute;A &EACUTE;", "caf\u00e9 \u00c9A &EACUTE;"),
    ("seen <!-- open", "seen "), ("a<!-- b --!> c --> d", "a d"), ('<a title="open>tail', "tail"), ("a <b", "a <b"), ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"),
    ("x<SCRIPT type='a>b'>if (a<b) '</p>' </script >y", "xy"), ("x<script>never closed <b>y</b>", "x"), ("<scripted>y</scripted>", "y"),
    ("<style>a > b {}</STYLE>z<styled>", "z"), ("x<script>'</scripts>'</script>y", "xy"), ("&#150;&#x96;&#129;&#8211;", "\u2013\u2013\x81\u2013"),
    ("&nosuch; &amp;eacute; &amp &;", "&nosuch; &eacute; &amp &;"), ("<!DOCTYPE html><?php x ?>t</p\n>", "t"), ("&NotEqualTilde;", "\u2242\u0338"),
    ("<p " + "a='>' b=\"<\" c " * 3000 + ">long</p>", "long"), ("<" + "p" * 50000 + ">", ""), ("", ""), (None, None)]


def test_strip_html_corner_cases_in_both_dialects(spark):
    import duckdb
    from ledgermatch.plans.oracle import strip_html
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(HTML_CASES)], "i int, s string")
    got = [r.o for r in df.select("i", T.strip_html(F.col("s")).alias("o")).orderBy("i").collect()]
    assert got == [c[1] for c in HTML_CASES]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, c[0]) for i, c in enumerate(HTML_CASES)])
    assert [r[0] for r in con.execute(f"SELECT {strip_html('s')} FROM t ORDER BY i").fetchall()] == got
