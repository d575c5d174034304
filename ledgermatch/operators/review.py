"""Review table: suppliers with their best register matches side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import matching

SUPPLIER_COLUMNS = ["SUPPLIER", "contractsfinder_awardedToVcse", "contractsfinder_region",
                    "date", "dept", "PAYMENT_TOTAL_AMOUNT", "ORG_COUNT",
                    "NORMALIZED_SUPPLIER", "PAYMENT_TOTAL_COUNT", "NHSSpend_CompanyNumber",
                    "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo", "deptcount"]
VERIFIED_COLUMNS = ["verified_normalized_spine_name", "verified_spine_uid",
                    "verified_normalized_ch_name", "verified_ch_uid",
                    "verified_nhsdigital_name"]
REVIEW_TYPES = ["spine", "ch", "nhsdigital"]


def matchable(suppliers_df: DataFrame) -> DataFrame:
    """Suppliers whose normalised name is not empty."""
    return suppliers_df.filter(F.col("NORMALIZED_SUPPLIER").isNotNull()
                               & (F.col("NORMALIZED_SUPPLIER") != ""))


def unnormalise(long_matches: DataFrame, name_col: str) -> DataFrame:
    """Original register name for every matched normalised name.

    The register's original name travels with each candidate pair through
    the match (register names are unique per normalised name after E7), so
    no lookup join back to the register is needed.
    """
    return long_matches.withColumnRenamed(name_col, "notnormalised")


def wide_with_names(long_named: DataFrame, match_type: str, k: int = 5) -> DataFrame:
    """Per supplier: match, score and original name for ranks 1..k."""
    return matching.by_rank(long_named, match_type, {"": "match", "_score": "score", "_notnormalised": "notnormalised"}, k)


def review_columns(k: int = 5) -> list[str]:
    cols = SUPPLIER_COLUMNS + VERIFIED_COLUMNS
    for t in REVIEW_TYPES:
        for i in range(1, k + 1):
            base = f"best_{t}_match_{i}"
            cols += [base, base + "_score", base + "_notnormalised"]
    return cols


def review_table(suppliers_df: DataFrame, named_wides: dict[str, DataFrame],
                 k: int = 5) -> DataFrame:
    """Suppliers + empty verification columns + per register the
    wide matches, joined on the normalised supplier name (a keyed join, not
    the reference's positional one)."""
    out = matchable(suppliers_df)
    for c in VERIFIED_COLUMNS:
        out = out.withColumn(c, F.lit(None).cast("string"))
    for t in REVIEW_TYPES:
        out = out.join(named_wides[t], "NORMALIZED_SUPPLIER", "left")
    return out.select(*review_columns(k))


def match_bands(long_matches: DataFrame) -> DataFrame:
    """M5: number of rank-1 matches per register by score band."""
    band = (F.when(F.col("score") >= 100, F.lit("exact"))
            .when(F.col("score") >= 90, F.lit("strong"))
            .when(F.col("score") >= 70, F.lit("medium"))
            .otherwise(F.lit("weak")))
    return (long_matches.filter(F.col("rank") == 1)
            .groupBy("match_type", band.alias("band"))
            .agg(F.count(F.lit(1)).alias("n_suppliers"),
                 F.avg("score").alias("avg_score")))


HISTOGRAM_BUCKETS = 10


def match_histogram(long_matches: DataFrame, buckets: int = HISTOGRAM_BUCKETS) -> DataFrame:
    """M5: distribution of rank-1 scores per register, in ``buckets`` of equal width over 0..100.

    ``bucket`` counts from 1; a score of 100 is in bucket ``buckets + 1``.  The
    margin is the lead of rank 1 over rank 2; a match without rival has its
    whole score for margin and is counted in ``n_alone``.
    """
    best = (long_matches.groupBy("match_type", "NORMALIZED_SUPPLIER")
            .agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("score"),
                 F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"))
            .filter(F.col("score").isNotNull()))
    margin = F.col("score") - F.coalesce("second", F.lit(0))
    return (best.groupBy("match_type", F.width_bucket(F.col("score").cast("double"), F.lit(0.0), F.lit(100.0), F.lit(buckets))
                         .cast("int").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_suppliers"),
                 F.count(F.when(F.col("second").isNull(), 1)).alias("n_alone"),
                 F.min(margin).alias("min_margin"), F.max(margin).alias("max_margin"),
                 F.avg(margin).alias("avg_margin")))


def score_sketches(long_matches: DataFrame) -> DataFrame:
    """M5: per register a KLL sketch (binary) of the rank-1 scores, of bounded size whatever the number of suppliers."""
    return (long_matches.filter(F.col("rank") == 1).groupBy("match_type")
            .agg(F.kll_sketch_agg_double(F.col("score").cast("double")).alias("sketch")))


def score_quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """match_type, n, quantiles (one per rank in 0..1) of sketches, those of several runs or parts merged per register.

    KLL of the default size errs by under 2 % of the ranks.
    """
    merged = sketches.groupBy("match_type").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("match_type", F.kll_sketch_get_n_double("sketch").alias("n"),
                         F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(r)) for r in ranks])).alias("quantiles"))


__all__ = ["matchable", "unnormalise", "wide_with_names", "review_table", "match_bands", "match_histogram",
           "score_sketches", "score_quantiles", "review_columns", "matching"]
