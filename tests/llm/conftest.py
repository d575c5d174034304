import pytest

LONG = ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et "
        "dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea "
        "commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur "
        "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum")
HUGE = " ".join(f"w{i % 977} x{i % 31}" for i in range(20_000))
#: Nulls in every column, empty and very long texts, repeated rows, names that operators use themselves.
ROWS = [(1, LONG, "la", "a"), (1, LONG, "la", "a"), (2, LONG + " finis", None, "a"), (3, None, "la", None),
        (4, "", "la", "b"), (None, LONG, "la", "b"), (None, None, None, None), (5, HUGE, "xx", "b"),
        (6, "a@b.example 1.2.3.4", "xx", ""), (6, "other words under one id " + LONG[::-1], "xx", "c")]
SCHEMA = "doc_id long, text string, lang string, source string"
EXTRA = ("n_chars long, fp string, root string, component_id string, spans string, n_words string, a string, P string, "
         "slots string, host string, score string, kept string, items string, label string")


@pytest.fixture(scope="session")
def hard(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), *["x"] * 13) for r in ROWS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], f"{SCHEMA}, {EXTRA}")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_bench(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
