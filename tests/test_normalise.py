"""Golden names (hand-traced from the rule order) through the whole chain."""

import duckdb
import pytest

from ledgermatch.functions import rules as R
from ledgermatch.functions.normalise import DUCKDB, STAGE_NAMES, normalise_frame, normalise_sql

GOLDEN = [
    ("The Smith & Co Limited", "SMITH COMPANY LTD"),
    ("Smith and Co Ltd", "SMITHAND COMPANY LTD"),
    ("1st Eltham Scout Group", "FIRST ELTHAM SCOUTS 1"),
    ("4th Leeds Cub Pack Scouts", "4 LEEDS CUBS PACK SCOUTS"),
    ("Café Ltd", "CAF LTD"),
    ("A B C Services Ltd", "ABC SERVICES LTD"),
    ("A.B.C. Services Ltd", "ABC SERVICES LTD"),
    ("Co-operative Group", "COOPERATIVE GROUP"),
    ("Co operative Group", "COOPERATIVE ERATIVE GROUP"),
    ("Leeds Community Interest Company (CIC)", "LEEDS CIC CIC"),
    ("Parents and Teachers Assoc of St. Mary", "ST MARY PTA"),
    ("Muslim", "MUSLTD"),
    ("Unlimited Ideas Limited", "UNLTD IDEAS LTD"),
    ("Housing Departments", "HOUSING DEPT S"),
    ("Twentieth Century Club", "20CENTURY CLUB"),
    ("Isle of Wight Football Club", "IOW FC"),
    ("Young Mens Christian Association", "YMCA"),
    ("Church of England School", "CE SCHOOL"),
    ("St. John's RC School", "ST JOHNS RC SCHOOL"),
    ("Newcastle upon Tyne Hospitals", "NEWCASTLE HOSPITALS"),
    ("Anytown CA", "ANYTOWN COMMUNITY ASSOC"),
    ("The", ""),
    ('"Acme Limited"', "ACME LIMITED"),
    ("nan", "NAN"),
    ("A  B C", "ABC"),  # blanks collapse (N4) before initials join (N11)
    ("X Y Z AB C D", "XYZ AB CD"),
]


def test_rule_table_sizes():
    assert [len(R.PUNCTUATION), len(R.APOSTROPHES), len(R.SPELLING), len(R.ABBREVIATIONS),
            len(R.STOPWORDS), len(R.DOMAIN)] == [27, 7, 54, 41, 10, 154]
    assert len(R.ordinal_digit_rules()) == 40
    assert R.ordinal_digit_rules()[:2] == [(" 0ST ", " 0 "), (" 0ND ", " 0 ")]


def test_golden_spark(spark):
    df = spark.createDataFrame(GOLDEN, "inp string, exp string")
    rows = normalise_frame(df, "inp", "got").collect()
    bad = [(r.inp, r.exp, r.got) for r in rows if r.got != r.exp]
    assert not bad


def test_golden_duckdb_dialect_agrees():
    con = duckdb.connect()
    con.execute("CREATE TABLE g(inp VARCHAR, exp VARCHAR)")
    con.executemany("INSERT INTO g VALUES (?, ?)", GOLDEN)
    q = "SELECT inp, exp, inp AS got FROM g"
    for expr in normalise_sql("got", DUCKDB):
        q = f"SELECT * REPLACE ({expr} AS got) FROM ({q})"
    bad = [r for r in con.sql(q).fetchall() if r[1] != r[2] and "é" not in r[0]]
    assert not bad


def test_stage_prefixes(spark):
    df = spark.createDataFrame([("The Smith & Co Limited",)], "inp string")
    padded = normalise_frame(df, "inp", "o", last_stage="pad").first().o
    assert padded == " THE SMITH & CO LIMITED "
    punct = normalise_frame(df, "inp", "o", last_stage="punct").first().o
    assert punct == " THE SMITH  CO LIMITED "
    assert STAGE_NAMES[0] == "pad" and STAGE_NAMES[-1] == "finish"


def test_unknown_stage(spark):
    df = spark.createDataFrame([("x",)], "inp string")
    with pytest.raises(ValueError):
        normalise_frame(df, "inp", "o", last_stage="nope")


def test_normalise_where_equals_the_frame(spark):
    from ledgermatch.functions.normalise import normalise_frame, normalise_where
    names = ["ST", "R&D", "A.B", "1ST", " X ", "LTD", "", None, "A LONGER NAME LTD"]
    df = normalise_frame(spark.createDataFrame([(n,) for n in names], "n string"), "n", "whole")
    rows = df.select("n", "whole", normalise_where("n", "length(n) <= 3").alias("short")).collect()
    assert [r.short for r in rows] == [r.whole if r.n is not None and len(r.n) <= 3 else None for r in rows]


def test_long_rule_tables_run_only_on_names_that_hold_one_of_their_texts(spark):
    import re

    from ledgermatch.functions import normalise as N
    from ledgermatch.functions import rules as R

    tables = [t for t in (R.PUNCTUATION, R.SPELLING, R.ABBREVIATIONS, R.STOPWORDS, R.DOMAIN, R.TAIL) if len(t) >= N.MANY]
    assert len(tables) >= 4
    for table in tables:
        finds = [find for find, _ in table]
        pattern = re.compile(N.any_of(finds))
        for text in ["", "ACME LTD", *finds, *[f[1:] for f in finds], *[f[:-1] for f in finds], *[f"x{f}y" for f in finds]]:
            assert (pattern.search(text) is not None) == any(f in text for f in finds), (text, finds)
        sql = N.fold_sql("x", table, N.SPARK)
        assert sql.startswith("(CASE WHEN (x RLIKE ") and "RLIKE" not in N.fold_sql("x", table, N.DUCKDB)
        df = spark.createDataFrame([(f"x{f}y",) for f in finds] + [(None,), ("",), ("A",)], "x string")
        plain = "x"
        for a, b in table:
            plain = f"replace({plain}, {N.SPARK.lit(a)}, {N.SPARK.lit(b)})"
        assert df.where(f"NOT ({sql} <=> {plain})").count() == 0
