"""CSV sources: odd headers, quotes, line breaks, labels, bad values; CSV export; restart of the pipeline."""

import datetime
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import payments, registers
from ledgermatch.plans import pipeline as P
from ledgermatch.sources import feeds, fixtures

from small import SMALL_SF


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="lm-csv-")


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_company_headers_and_history(spark, folder):
    now = put(folder, "now.csv", 'CompanyName, CompanyNumber,Extra,RegAddress.PostTown,RegAddress.PostCode\n'
                                 '"ACME ""BEST"" LTD",00000001,x,"TOWN,\nNORTH",AB1\nBETA LTD,00000002,x,,\n')
    old = [put(folder, f"old{i}.csv", ' CompanyNumber,CompanyName,RegAddress.PostTown,RegAddress.PostCode\n'
                                      f'00000001,OLD ACME {i},OLD,ZZ\n0000001{i},GAMMA {i},OLD,ZZ\n') for i in range(4)]
    raw = feeds.company(spark, now, *old)
    first = {r.CompanyNumber: r for r in registers.company_snapshot_merge(raw).collect()}
    assert len(raw.columns) == 6 and len(first) == 6
    assert (first["00000001"].CompanyName, first["00000001"].PostTown) == ('ACME "BEST" LTD', "TOWN,\nNORTH")
    assert first["00000002"].PostTown is None
    order = sorted(first.values(), key=lambda r: r.choice_ord)
    assert [r.CompanyName for r in order[2:]] == [f"GAMMA {i}" for i in range(4)]


def test_rows_of_many_files_keep_their_order(spark, folder):
    """By file name, then by line: whatever the files' sizes, and if files are read in parts."""
    sizes = [("part0.csv", 3), ("part1.csv", 4000), ("part2.csv", 300), ("part10.csv", 50)]
    for name, n in sizes:
        put(folder, name, "NHSDigital_Supplier\n" + "".join(f"{name} {i} {'x' * (i % 90)}\n" for i in range(n)))
    want = [f"{name} {i} {'x' * (i % 90)}".strip() for name, n in sorted(sizes) for i in range(n)]
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (None, "20000"):
            for c in before if size else ():
                spark.conf.set(c, size)
            for multi_line in (True, False):
                rows = feeds.nhs_list(spark, folder, multi_line=multi_line)
                got = sorted(rows.collect(), key=lambda r: r.k1)
                assert [r.NHSDigital_Supplier.strip() for r in got] == want and [r.k1 for r in got] == list(range(len(want)))
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert feeds.nhs_list(spark, folder, multi_line=False).rdd.getNumPartitions() > 1


def test_feeds_labels_and_bad_values(spark, folder):
    path = put(folder, "spend.csv", "dept,date,supplier,amount\nA,01/02/2020,X LTD,12.5\nB,01/02/2020,Y LTD,twelve\n")
    rows = payments.prepare_centgov(feeds.centgov(spark, path, path, label="Central")).collect()
    assert [(r.data_source, r.amount, r.supplier) for r in sorted(rows, key=lambda r: r.row_ord)] == [
        ("Central", 12.5, "X LTD"), ("Central", None, "Y LTD")] * 2
    assert feeds.centgov(spark, path).first().data_source == "Contracts Finder"
    nhs = payments.prepare_nhs(feeds.nhs(spark, path)).first()
    assert nhs.supplier == "X LTD" and nhs.NHSSpend_CompanyNumber is None
    path = put(folder, "awards.csv", "awardedDate,awardedSupplier,awardedValue,organisationName,awardedToVcse,region\n"
                                     "2020-01-01,Z LTD,1,Org,True,North\n2020-01-01,Z LTD,1,Org,perhaps,\n")
    union = payments.union_feeds(payments.prepare_nhs(feeds.nhs(spark, path)), payments.prepare_centgov(feeds.centgov(spark, path)),
                                 payments.prepare_contracts(feeds.awards(spark, path)))
    got = union.where("contractsfinder_region IS NOT NULL OR contractsfinder_awardedToVcse IS NOT NULL").collect()
    assert [(r.SUPPLIER, r.contractsfinder_awardedToVcse) for r in got] == [("Z LTD", True)]


def test_a_null_amount_is_dropped_with_its_reason(spark, folder):
    path = put(folder, "spend.csv", "dept,date,supplier,amount\nA,01/02/2020,XENON LTD,\nA,01/02/2020,XENON LTD,3\n")
    union = payments.union_feeds(payments.prepare_nhs(feeds.nhs(spark, path).limit(0)), payments.prepare_centgov(feeds.centgov(spark, path)),
                                 payments.prepare_contracts(feeds.awards(spark, path).limit(0)))
    assert {r.reason: r.n_rows for r in payments.drop_audit(union).collect()} == {"null_amount": 1, "kept": 1}


def test_csv_export_keeps_arrays(spark, folder):
    df = spark.createDataFrame([('a "q"', ["x", None]), (None, [])], "name string, dept array<string>")
    feeds.write_csv(df, f"{folder}/out")
    back = spark.read.options(header=True, escape='"').csv(f"{folder}/out")
    assert sorted((r.name or "", feeds.from_json_text(r.dept)) for r in back.collect()) == [("", []), ('a "q"', ["x", None])]


def test_restart_from_a_stage(spark, folder):
    spine = feeds.spine(spark, put(folder, "spine.csv", "uid,organisationname,fulladdress,city,postcode,registerdate,removeddate\n"
                                                        "1,GREEN TRUST,x,y,z,01/01/2000,\n"))
    nhs_list = feeds.nhs_list(spark, put(folder, "list.csv", "NHSDigital_Supplier\nXENON LTD\n"))
    company = feeds.company(spark, put(folder, "ch.csv", "CompanyName, CompanyNumber,RegAddress.PostTown,RegAddress.PostCode\nXENON LTD,1,A,B\n"))
    pay = put(folder, "spend.csv", "dept,date,supplier,amount\nA,01/02/2020,XENON LTD,3\n")
    inputs = P.Inputs(feeds.nhs(spark, pay).limit(0), feeds.centgov(spark, pay), feeds.awards(spark, pay).limit(0),
                      {"spine": spine, "ch": company, "nhsdigital": nhs_list})
    out = f"{folder}/run"
    paths = P.run(spark, SMALL_SF, out, inputs=inputs)
    review = spark.read.parquet(paths["review"]).collect()
    assert [(r.best_ch_match_1_notnormalised, r.best_ch_match_1_score) for r in review] == [("XENON LTD", 100.0)]
    before = os.path.getmtime(f"{out}/payments_clean/_SUCCESS")
    again = P.run(spark, SMALL_SF, out, inputs=inputs, from_stage="matches")
    assert again == paths and os.path.getmtime(f"{out}/payments_clean/_SUCCESS") == before
    assert spark.read.parquet(again["review"]).collect() == review
    assert again.ran == ["matches", "review"] and again.counts == paths.counts
    assert {k: again.counts["register_ch"][k] for k in ("read_rows", "merged_rows", "n_rows")} == dict.fromkeys(
        ("read_rows", "merged_rows", "n_rows"), 1)
    assert again.counts["suppliers"] == {"n_rows": 1, "n_matchable": 1}
    with pytest.raises(ValueError):
        P.run(spark, SMALL_SF, out, from_stage="nowhere")
    # a stage that lost a file, one without a manifest and one whose input has changed are run again, with what follows from it
    part = next(f for f in os.listdir(f"{out}/register_spine") if f.endswith(".parquet"))
    os.remove(f"{out}/register_spine/{part}")
    for f in os.listdir(f"{out}/manifests/payments_output"):
        os.remove(f"{out}/manifests/payments_output/{f}")
    put(folder, "ch.csv", "CompanyName, CompanyNumber,RegAddress.PostTown,RegAddress.PostCode\nXENON LTD,1,A,B\nXENON TWO LTD,2,A,B\n")
    company = feeds.company(spark, os.path.join(folder, "ch.csv"))
    inputs = P.Inputs(inputs.nhs, inputs.centgov, inputs.contracts, {**inputs.registers, "ch": company})
    third = P.run(spark, SMALL_SF, out, inputs=inputs, from_stage="review")
    assert third.ran == ["payments_output", "register_spine", "register_ch", "matches", "review"]
    assert third.counts["register_ch"]["n_rows"] == 2
    assert os.path.getmtime(f"{out}/payments_clean/_SUCCESS") == before


def test_run_over_empty_inputs(spark, folder):
    """Every stage is written with its columns and no rows; all counts are zero."""
    given = P.Inputs.of_tables(spark, SMALL_SF)
    empty = P.Inputs(given.nhs.limit(0), given.centgov.limit(0), given.contracts.limit(0), {t: df.limit(0) for t, df in given.registers.items()})
    run = P.run(spark, SMALL_SF, f"{folder}/empty", inputs=empty)
    assert run.ran == P.STAGES and all(v == 0 for counts in run.counts.values() for v in counts.values())
    assert run.counts["payments_clean"]["multi_org"] == 0
    assert spark.read.parquet(run["suppliers"]).count() == 0


def line_tables(spark, folder):
    """The tables of two dozen line items, of which one comes twice and some have no part, below ``folder``."""
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp_ntz")
    rows = [(o, p, 1, n, 10.0 * o, "R", "F" if o % 2 else "O", datetime.datetime(1996, 9, 1 + o)) for o in range(14) for p, n in ((1, o % 7 + 1), (9, 1))]
    tables = {"lineitem": (rows + rows[:1], line),
              "part": ([(1, "hot bolt", "LARGE", "Brand#7"), (1, "hot bolt", "LARGE", "Brand#7"), (None, "x", "y", "z")], "p_partkey long, p_name string, p_type string, p_brand string"),
              "supplier": ([(1, 2)], "s_suppkey long, s_nationkey int"), "nation": ([(2, 3, "PERU")], "n_nationkey int, n_regionkey int, n_name string"),
              "region": ([(3, "AMERICA")], "r_regionkey int, r_name string"), "customer": ([(5, "Customer#5", 2)], "c_custkey long, c_name string, c_nationkey int"),
              "orders": ([(1, 5, 3.0, datetime.datetime(1998, 2, 6))], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz")}
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))


def test_both_feeds_of_line_items_come_from_one_pass(spark, folder):
    line_tables(spark, folder)
    one, apart = P.payments_union(spark, folder), payments.union_feeds(*P.feeds(spark, folder))
    assert one.schema.simpleString() == apart.schema.simpleString()
    rows = sorted(map(str, one.collect()))
    assert rows == sorted(map(str, apart.collect())) and len(rows) > 50
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") > 0 and plan.count("Relation [l_orderkey") == 1


def test_a_payment_makes_the_text_of_its_date_once(spark, folder):
    line_tables(spark, folder)
    plan = fixtures.fixture(spark, folder, "payments")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(l_shipdate#\d+ as string\)", plan)) == 1
