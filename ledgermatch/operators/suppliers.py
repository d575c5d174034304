"""Per-supplier roll-up of cleaned payments.

One logical aggregate replaces the reference's list pivot, sum, count and two
joins.  It runs in two levels so that a supplier holding a large share of all
payments never lands whole in one task:

1. ``groupBy(SUPPLIER, dept, region, vcse)`` with map-side partial
   aggregation: the first position, sum, count and date bounds of every
   distinct value combination.  Its size is bounded by the value domains,
   not by the number of payments.  Positions are packed in one decimal, so that
   this is a hash aggregate: no payment is sorted.
2. ``groupBy(SUPPLIER)`` over those combinations: first-seen-order distinct
   lists are built from (first position, value) pairs, sums and counts are
   added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_range_text, fmt_dmy
from ..functions.normalise import normalise_frame
from ..functions.text import org_counter, quote_escape, supplier_clean
from .payments import packed_ord

LIST_COLUMNS = {"dept": "dept", "contractsfinder_region": "region",
                "contractsfinder_awardedToVcse": "vcse"}


def _first_seen_list(value: str) -> Column:
    """Distinct values ordered by first appearance; missing values kept."""
    # sort_array compares by compiled code, array_sort by an interpreted lambda.
    return F.array_distinct(F.sort_array(F.collect_list(F.struct(F.col("first_ord"), F.col(value).alias("v"))))["v"])


def rollup(clean_rows: DataFrame) -> DataFrame:
    """Aggregate cleaned payments to one row per SUPPLIER (before the id join).

    Columns: SUPPLIER, dept, region, vcse (lists), any_vcse, min_date,
    max_date, date_list, PAYMENT_TOTAL_AMOUNT, PAYMENT_TOTAL_COUNT.
    """
    df = clean_rows
    if "contractsfinder_region" not in df.columns:
        df = df.withColumn("contractsfinder_region", F.lit(None).cast("string"))
    if "contractsfinder_awardedToVcse" not in df.columns:
        df = df.withColumn("contractsfinder_awardedToVcse", F.lit(None).cast("boolean"))
    combos = (df.groupBy("SUPPLIER",
                         F.col("dept"),
                         F.col("contractsfinder_region").alias("region"),
                         F.col("contractsfinder_awardedToVcse").alias("vcse"))
              .agg(F.min(packed_ord("row_ord")).alias("first_ord"),
                   F.sum("amount").alias("amount"),
                   F.count(F.lit(1)).alias("n"),
                   F.min("pay_date").alias("min_date"),
                   F.max("pay_date").alias("max_date")))
    return (combos.groupBy("SUPPLIER")
            .agg(_first_seen_list("dept").alias("dept"),
                 _first_seen_list("region").alias("region"),
                 _first_seen_list("vcse").alias("vcse"),
                 F.min("first_ord").alias("first_ord"),
                 F.coalesce(F.bool_or("vcse"), F.lit(False)).alias("any_vcse"),
                 F.min("min_date").alias("min_date"),
                 F.max("max_date").alias("max_date"),
                 F.sum("amount").alias("PAYMENT_TOTAL_AMOUNT"),
                 F.sum("n").alias("PAYMENT_TOTAL_COUNT")))


def date_list(clean_rows: DataFrame) -> DataFrame:
    """E1 for the date column: per supplier, distinct payment dates in
    first-seen order (pre-aggregated per (supplier, date), dates written as text after that)."""
    firsts = (clean_rows.groupBy("SUPPLIER", "pay_date").agg(F.min(packed_ord("row_ord")).alias("first_ord"))
              .withColumn("date", fmt_dmy(F.col("pay_date"))))
    return firsts.groupBy("SUPPLIER").agg(_first_seen_list("date").alias("date_list"))


NHS_ID_TUPLE = ["supplier", "NHSSpend_CompanyName", "NHSSpend_CompanyNumber",
                "NHSSpend_CharityName", "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo",
                "NHSSpend_CharityNameNo"]
NHS_ID_KEEP = ["NHSSpend_CompanyNumber", "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo"]


def nhs_ids(nhs_feed: DataFrame) -> DataFrame:
    """Distinct id tuples of the prepared NHS feed, keyed by the *raw*
    supplier text (not upper-cased: only names already upper-case match)."""
    return (nhs_feed.select(*NHS_ID_TUPLE).distinct()
            .withColumnRenamed("supplier", "nhs_supplier"))


def suppliers(clean_rows: DataFrame, nhs_feed: DataFrame, profile: str = "notebook",
              normalise_key: bool = False) -> DataFrame:
    """The unique-suppliers table (A8) in the reference's column order.

    ``profile='script'`` reproduces the batch script's variants: dept count
    by counting ';' in the printed list, region list never blanked.  With
    ``normalise_key`` the NHS ids join on the cleaned supplier text.
    """
    agg = rollup(clean_rows)
    org = org_counter(F.col("SUPPLIER"))
    agg = agg.withColumn("ORG_COUNT", org["n"]).withColumn("SUPPLIER", org["name"])
    agg = normalise_frame(agg, "SUPPLIER", "NORMALIZED_SUPPLIER")
    # D3: fan-out join on raw NHS supplier text; the name columns are dropped
    # after the join, so duplicate rows can reappear (as in the reference).
    ids = nhs_ids(nhs_feed)
    if normalise_key:
        ids = ids.withColumn("nhs_supplier", supplier_clean(F.col("nhs_supplier"))).distinct()
    joined = agg.join(ids, agg["SUPPLIER"] == ids["nhs_supplier"], "left")
    joined = joined.filter(F.col("ORG_COUNT") == 1)
    region = F.col("region")
    if profile == "notebook":
        region = F.when((F.size(region) == 1) & region[0].isNull(),
                        F.array().cast("array<string>")).otherwise(region)
        deptcount = F.size("dept")
    else:
        printed = F.array_join("dept", ", ")
        deptcount = F.length(printed) - F.length(F.replace(printed, F.lit(";"), F.lit(""))) + 1
    return joined.select(
        quote_escape(F.col("SUPPLIER")).alias("SUPPLIER"),
        F.when(F.col("any_vcse"), F.lit("True")).otherwise(F.lit("False"))
        .alias("contractsfinder_awardedToVcse"),
        region.alias("contractsfinder_region"),
        date_range_text(F.col("min_date"), F.col("max_date")).alias("date"),
        F.col("dept"),
        F.col("PAYMENT_TOTAL_AMOUNT"),
        F.col("ORG_COUNT"),
        F.col("NORMALIZED_SUPPLIER"),
        F.col("PAYMENT_TOTAL_COUNT"),
        *NHS_ID_KEEP,
        deptcount.cast("int").alias("deptcount"),
    )


def by_spend(suppliers_df: DataFrame) -> DataFrame:
    """Largest total spend first (nulls last); name breaks ties."""
    return suppliers_df.orderBy(F.desc_nulls_last("PAYMENT_TOTAL_AMOUNT"), F.asc("SUPPLIER"))
