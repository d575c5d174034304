"""Payment feeds: shape, union, clean, audit.

Every step is a narrow projection or filter over the payment rows (no
shuffle), except the row-level normalised name, which is computed once per
distinct supplier text and joined back.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import fmt_dmy, with_mixed_date
from ..functions.normalise import normalise_frame, normalise_where, once, plain_short
from ..functions.text import (is_numeric_text, is_redacted, quote_escape,
                              strip_html, supplier_clean, with_org)

CORE = ["data_source", "amount", "supplier", "date", "dept"]
NHS_ID_COLUMNS = ["CompanyName", "CompanyNumber", "CharityRegNo", "CharitySubNo",
                  "CharityNameNo", "CharityName", "audit_type", "CHnotes", "CCnotes", "isCIC"]
# Keys of a payment's position, with the decimal digits that each may have: 38 in all, one decimal number.
ORD_DIGITS = {"feed_ord": 1, "k1": 13, "k2": 2, "k3": 12, "k4": 10}
ORD_KEYS = list(ORD_DIGITS)


def row_ord(df: DataFrame) -> Column:
    """Position of a payment in the unified feed (feed first, then file order)."""
    return F.struct(*[F.col(c).cast("long").alias(c) for c in ORD_KEYS])


def packed_ord(ord_col: str) -> Column:
    """A ``row_ord`` as one decimal of the same order, which hash aggregates can hold.

    A key that is negative or has more digits than ``ORD_DIGITS`` is an error.
    """
    def key(name: str) -> Column:
        value = F.col(ord_col)[name]
        return F.when(value.between(0, 10 ** ORD_DIGITS[name] - 1), value).otherwise(
            F.raise_error(F.concat(F.lit(f"{name} out of range in a payment's position: "), F.coalesce(value.cast("string"), F.lit("null")))))

    digits = ORD_DIGITS
    high = (key("feed_ord") * 10 ** digits["k1"] + key("k1")) * 10 ** digits["k2"] + key("k2")
    low = digits["k3"] + digits["k4"]
    return (high.cast("decimal(16,0)") * F.lit(Decimal(10 ** low)) + key("k3").cast("decimal(12,0)") * F.lit(Decimal(10 ** digits["k4"]))
            + key("k4")).cast("decimal(38,0)")


# -- B1 / B2 / B3: shape the three feeds --------------------------------------
def prepare_centgov(df: DataFrame) -> DataFrame:
    return df.select(*CORE, row_ord(df).alias("row_ord"))


def prepare_nhs(df: DataFrame) -> DataFrame:
    """Prefix the id columns with NHSSpend_ and keep the 15 used columns."""
    renamed = df.withColumnsRenamed({c: "NHSSpend_" + c for c in NHS_ID_COLUMNS})
    return renamed.select(*CORE, *["NHSSpend_" + c for c in NHS_ID_COLUMNS],
                          row_ord(df).alias("row_ord"))


def prepare_contracts(df: DataFrame) -> DataFrame:
    """Alias the award columns to the core names."""
    return df.select(
        "data_source",
        F.col("awardedValue").alias("amount"),
        F.col("awardedSupplier").alias("supplier"),
        F.col("awardedDate").alias("date"),
        F.col("organisationName").alias("dept"),
        F.col("awardedToVcse").cast("boolean").alias("contractsfinder_awardedToVcse"),
        F.col("region").alias("contractsfinder_region"),
        row_ord(df).alias("row_ord"),
    )


def union_feeds(nhs: DataFrame, centgov: DataFrame, contracts: DataFrame) -> DataFrame:
    """Rows of all feeds by column name; missing columns become null."""
    return union_lines(nhs.unionByName(centgov, allowMissingColumns=True), contracts)


def union_lines(nhs: DataFrame, lines: DataFrame) -> DataFrame:
    """U1 of feeds of which some are one frame already."""
    return nhs.unionByName(lines, allowMissingColumns=True).withColumnRenamed("supplier", "SUPPLIER")


# -- cleaning -----------------------------------------------------------------
DROP_REASONS = ["null_supplier", "numeric_supplier", "null_date", "null_amount",
                "null_dept", "short_name", "redacted", "multi_org"]
# Columns without which a rule drops the row, whatever the other rules say.
NEEDED = ("SUPPLIER", "amount", "date", "dept")


def supplier_text(payments: DataFrame, needed: tuple[str, ...] = ()) -> DataFrame:
    """``SUPPLIER`` cleaned and without markup, and ``is_numeric``; only rows that have all columns of ``needed``.

    ``once`` keeps the feed's own expressions out of the steps that follow.
    """
    df = payments.withColumn("SUPPLIER", once(supplier_clean(F.col("SUPPLIER"))))
    for c in needed:
        df = df.where(F.col(c).isNotNull())
    return (df.withColumn("is_numeric", is_numeric_text(F.col("SUPPLIER")))
            .withColumn("SUPPLIER", strip_html(F.col("SUPPLIER"))))


def annotate(payments: DataFrame, needed: tuple[str, ...] = ()) -> DataFrame:
    """Add the cleaned columns and ``drop_reason`` (null when the row is kept).

    The reference filters one rule at a time; a row is dropped by the first
    rule it fails, so one CASE over the rules in the same order gives the
    same survivors and an exact per-rule audit in a single pass.  ``once``
    keeps a filter on ``drop_reason`` from computing the steps a second time.
    Rows without a value in a column of ``needed`` leave before the steps.
    """
    df = with_mixed_date(supplier_text(payments, needed), "date", "pay_date")
    # The normaliser only decides the length rule for names of three
    # characters or fewer, and leaves most of these as they are.
    plain = plain_short("SUPPLIER")
    df = df.withColumn("is_short", F.when(F.length("SUPPLIER") <= 3, F.expr(plain) | F.coalesce(
        F.length(normalise_where("SUPPLIER", f"length(SUPPLIER) <= 3 AND NOT {plain}")) <= 3, F.lit(False))).otherwise(F.lit(False)))
    df = with_org(df, "SUPPLIER", "org_name", "org_n")
    reason = F.coalesce(
        F.when(F.col("SUPPLIER").isNull(), F.lit("null_supplier")),
        F.when(F.col("is_numeric"), F.lit("numeric_supplier")),
        F.when(F.col("pay_date").isNull(), F.lit("null_date")),
        F.when(F.col("amount").isNull(), F.lit("null_amount")),
        F.when(F.col("dept").isNull(), F.lit("null_dept")),
        F.when(F.col("is_short"), F.lit("short_name")),
        F.when(is_redacted(F.col("org_name")), F.lit("redacted")),
        F.when(F.col("org_n") != 1, F.lit("multi_org")),
    )
    return df.withColumn("drop_reason", once(reason))


def drop_counts() -> list[Column]:
    """C15 as aggregates over ``annotate``'s rows, for ``DataFrame.observe``: one count per rule and ``kept``."""
    reason = F.coalesce("drop_reason", F.lit("kept"))
    return [F.count(F.when(reason == r, 1)).alias(r) for r in [*DROP_REASONS, "kept"]]


def drop_audit(payments: DataFrame) -> DataFrame:
    """Rows dropped per rule (first failing rule wins) plus rows kept."""
    a = annotate(payments)
    return (a.select(F.coalesce("drop_reason", F.lit("kept")).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


def clean(payments: DataFrame, audit: Observation | None = None) -> DataFrame:
    """Rows that pass every rule, shaped like the reference's cleaned payments.

    ``SUPPLIER_TEXT`` is the supplier text before the organisation split; the
    row-level ``NORMALIZED_SUPPLIER`` is derived from it (as the reference
    does), while the roll-up re-derives names from ``SUPPLIER``.  ``audit``
    takes the drop counts while the rows pass; without it, rows that lack a
    value every kept row has are not cleaned at all.
    """
    a = annotate(payments, NEEDED if audit is None else ())
    if audit is not None:
        a = a.observe(audit, *drop_counts())
    a = a.filter(F.col("drop_reason").isNull())
    out = a.select(
        *[c for c in a.columns if c not in {"SUPPLIER", "date", "pay_date", "is_numeric",
                                            "is_short", "org_name", "org_n", "drop_reason"}],
        F.col("SUPPLIER").alias("SUPPLIER_TEXT"),
        F.col("org_name").alias("SUPPLIER"),
        F.col("org_n").alias("ORG_COUNT"),
        F.col("pay_date"),
        fmt_dmy(F.col("pay_date")).alias("date"),
    )
    return out


def with_row_normalised(clean_rows: DataFrame, payments: DataFrame | None = None) -> DataFrame:
    """Attach NORMALIZED_SUPPLIER per payment row.

    Names repeat across payments, so the normaliser runs once per distinct
    supplier text and the result is joined back (AQE broadcasts the name
    table when it is small, else shuffles both sides on the name).  The texts
    come from ``payments``, the rows before cleaning, where these are given: that
    reads and cleans the supplier column alone, not all columns a second time.
    """
    if payments is None:
        texts = clean_rows.select("SUPPLIER_TEXT")
    else:
        texts = (supplier_text(payments.select("SUPPLIER")).where("NOT is_numeric")
                 .select(F.col("SUPPLIER").alias("SUPPLIER_TEXT")))
    names = normalise_frame(texts.distinct(), "SUPPLIER_TEXT", "NORMALIZED_SUPPLIER")
    return clean_rows.join(names, "SUPPLIER_TEXT", "left")


NHS_DROPPED_FROM_PAYMENTS = ["NHSSpend_CharityNameNo", "NHSSpend_CharityName",
                            "NHSSpend_CompanyName", "NHSSpend_audit_type",
                            "NHSSpend_CHnotes", "NHSSpend_CCnotes"]


def payments_output(clean_rows: DataFrame, quote_escape_supplier: bool = True, payments: DataFrame | None = None) -> DataFrame:
    """The cleaned-payments table as written (A9): row-level normalised name,
    NHS name/notes columns dropped, double quotes escaped in SUPPLIER.
    ``payments`` as in ``with_row_normalised``."""
    df = with_row_normalised(clean_rows, payments)
    df = df.drop(*[c for c in NHS_DROPPED_FROM_PAYMENTS if c in df.columns])
    if quote_escape_supplier:
        df = df.withColumn("SUPPLIER", quote_escape(F.col("SUPPLIER")))
    return df.drop("SUPPLIER_TEXT", "pay_date")
