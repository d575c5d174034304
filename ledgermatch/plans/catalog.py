"""Registered queries: one Spark builder per operator key, and the DuckDB
oracle SQL for the keys that SQL can express.

Every builder reads the driver tables below ``sf_dir`` in full.  Outputs are
flat (lists rendered as '|'-joined text, money rounded to cents) so that the
oracle can compare values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.normalise import STAGE_NAMES, normalise_frame
from ..operators import grams as G
from ..operators import matching as M
from ..operators import payments as PM
from ..operators import registers as RG
from ..operators import review as RV
from ..operators import suppliers as SP
from ..session import ensure_checkpoint_dir
from ..sources.fixtures import fixture, read_table
from . import oracle as O
from . import pipeline as P

KEYS = ["feed_ord", "k1", "k2", "k3", "k4"]
UNION_COLUMNS = ["data_source", "amount", "SUPPLIER", "date", "dept",
                 *[f"NHSSpend_{c}" for c in PM.NHS_ID_COLUMNS],
                 "contractsfinder_awardedToVcse", "contractsfinder_region"]


OUTPUT_REST = ["data_source", "contractsfinder_awardedToVcse", "contractsfinder_region", "NHSSpend_CompanyNumber",
               "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo", "NHSSpend_isCIC"]


def list_text(col: Column) -> Column:
    return F.array_join(F.transform(col, lambda x: F.coalesce(x.cast("string"), F.lit("NULL"))), "|")


def keyed(df: DataFrame, *cols) -> DataFrame:
    return df.select(*[F.col("row_ord")[k].alias(k) for k in KEYS], *cols)


def iso(col: Column) -> Column:
    """Dates leave as ISO text so both engines hash them alike."""
    return F.date_format(col, "yyyy-MM-dd")


def cents(col: str) -> Column:
    return F.round(F.col(col), 2).alias(col)


# -- Spark builders -----------------------------------------------------------------------
def q_feed_counts(spark, sf):
    u = P.payments_union(spark, sf)
    return u.groupBy("data_source").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.round(F.sum("amount"), 2).alias("amount"))


def q_feed_nhs(spark, sf):
    return P.feeds(spark, sf)[0].drop("row_ord")


def q_feed_awards(spark, sf):
    return P.feeds(spark, sf)[2].drop("row_ord")


def q_payments_union(spark, sf):
    return P.payments_union(spark, sf).select(*UNION_COLUMNS)


def q_supplier_clean(spark, sf):
    u = P.payments_union(spark, sf)
    return keyed(u, T.supplier_clean(F.col("SUPPLIER")).alias("SUPPLIER"))


def q_filter_numeric(spark, sf):
    u = P.payments_union(spark, sf).withColumn("S", T.supplier_clean(F.col("SUPPLIER")))
    return keyed(u.filter(T.is_numeric_text(F.col("S"))), F.col("S").alias("SUPPLIER"))


def q_html_text(spark, sf):
    u = P.payments_union(spark, sf)
    return keyed(u, T.strip_html(T.supplier_clean(F.col("SUPPLIER"))).alias("text"))


def q_pages_text(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", T.strip_html(F.col("html")).alias("text"))


def q_parse_mixed_date(spark, sf):
    u = P.payments_union(spark, sf)
    return keyed(u, F.col("date").alias("date_text"),
                 D.fmt_dmy(D.parse_mixed_date(F.col("date"))).alias("date"))


def q_parse_ymd(spark, sf):
    u = P.payments_union(spark, sf)
    text = F.replace(F.col("date"), F.lit("-"), F.lit("/"))
    return keyed(u, text.alias("date_text"), iso(D.parse_ymd(text)).alias("date"))


def q_org_counter(spark, sf):
    u = P.payments_union(spark, sf)
    s = T.strip_html(T.supplier_clean(F.col("SUPPLIER")))
    u = u.withColumn("S", s).filter(F.col("S").isNotNull()).withColumn("org", T.org_counter(F.col("S")))
    return keyed(u, F.col("org.name").alias("org_name"), F.col("org.n").alias("org_n"))


def q_drop_audit(spark, sf):
    return PM.drop_audit(P.payments_union(spark, sf))


def q_payments_clean(spark, sf):
    c = P.clean_payments(spark, sf)
    return keyed(c, "SUPPLIER", "SUPPLIER_TEXT", "ORG_COUNT", "date", "amount", "dept",
                 "contractsfinder_awardedToVcse", "contractsfinder_region",
                 "NHSSpend_CompanyNumber", "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo")


def q_payments_output(spark, sf):
    union = P.payments_union(spark, sf)
    out = PM.payments_output(PM.clean(union), payments=union)
    return keyed(out, "SUPPLIER", "NORMALIZED_SUPPLIER", "ORG_COUNT", "date", "amount", "dept", *OUTPUT_REST)


def _all_names(spark, sf) -> DataFrame:
    pay = fixture(spark, sf, "payments").select(F.col("supplier").alias("name"))
    ch = fixture(spark, sf, "company").select(F.col("CompanyName").alias("name"))
    sp = fixture(spark, sf, "spine").select(F.col("organisationname").alias("name"))
    nh = fixture(spark, sf, "nhslist").select(F.col("NHSDigital_Supplier").alias("name"))
    return pay.unionByName(ch).unionByName(sp).unionByName(nh).filter(F.col("name").isNotNull()).distinct()


def q_normalise_name(spark, sf):
    return normalise_frame(_all_names(spark, sf), "name", "normalised")


def make_norm_stage(stage):
    def q(spark, sf):
        return normalise_frame(_all_names(spark, sf), "name", "normalised", last_stage=stage)
    return q


def _suppliers_flat(df: DataFrame) -> DataFrame:
    return df.select(
        "SUPPLIER", "contractsfinder_awardedToVcse",
        list_text(F.col("contractsfinder_region")).alias("contractsfinder_region"),
        "date", list_text(F.col("dept")).alias("dept"), cents("PAYMENT_TOTAL_AMOUNT"),
        "ORG_COUNT", "NORMALIZED_SUPPLIER", "PAYMENT_TOTAL_COUNT", "NHSSpend_CompanyNumber",
        "NHSSpend_CharityRegNo", "NHSSpend_CharitySubNo", "deptcount")


def q_suppliers(spark, sf):
    return _suppliers_flat(P.suppliers_table(spark, sf))


def q_suppliers_script(spark, sf):
    return _suppliers_flat(P.suppliers_table(spark, sf, profile="script"))


def q_suppliers_by_spend(spark, sf):
    return SP.by_spend(_suppliers_flat(P.suppliers_table(spark, sf)))


def q_supplier_identity(spark, sf):
    return P.suppliers_table(spark, sf).select("SUPPLIER", *SP.NHS_ID_KEEP)


def q_supplier_rollup(spark, sf):
    r = SP.rollup(P.clean_payments(spark, sf))
    return r.select("SUPPLIER", cents("PAYMENT_TOTAL_AMOUNT"), "PAYMENT_TOTAL_COUNT")


def q_supplier_lists(spark, sf):
    r = SP.rollup(P.clean_payments(spark, sf))
    return r.select("SUPPLIER", list_text(F.col("dept")).alias("dept_list"),
                    list_text(F.col("region")).alias("region_list"),
                    list_text(F.col("vcse")).alias("vcse_list"))


def q_supplier_date_list(spark, sf):
    r = SP.date_list(P.clean_payments(spark, sf))
    return r.select("SUPPLIER", list_text(F.col("date_list")).alias("date_list"))


def q_date_range(spark, sf):
    r = SP.rollup(P.clean_payments(spark, sf))
    return r.select("SUPPLIER", D.date_range_text(F.col("min_date"), F.col("max_date")).alias("date"))


def q_register_snapshot_merge(spark, sf):
    return RG.company_snapshot_merge(fixture(spark, sf, "company"))


def q_register_company(spark, sf):
    return P.company_register(spark, sf)


def q_register_spine(spark, sf):
    return P.spine_register(spark, sf).withColumn("removeddate", iso(F.col("removeddate")))


def q_register_nhs(spark, sf):
    return P.nhs_register(spark, sf)


def q_register_asof_split(spark, sf):
    sp = P.spine_register(spark, sf)
    return sp.select("uid", iso(F.col("removeddate")).alias("removeddate"),
                     RG.closed_by(F.col("removeddate")).alias("closed2010"))


def _sup_regs(spark, sf, *match_types):
    """Suppliers and the registers that ``match_types`` use (all without any), each cut from its lineage with a reliable
    checkpoint (shared checkpoint dir): the match plans that follow stay
    small, join these tables with themselves without re-deriving them, and
    a lost executor recomputes from the checkpoint, not from the feeds."""
    ensure_checkpoint_dir(spark)
    sup = P.suppliers_table(spark, sf).checkpoint()
    used = {"spine" if t.startswith("spine") else t for t in match_types}
    regs = {t: df.checkpoint() for t, df in P.all_registers(spark, sf).items() if not used or t in used}
    return sup, regs


def q_exact_match(spark, sf):
    sup, regs = _sup_regs(spark, sf, "ch")
    reg, key = P.register_for("ch", P.matchable_registers(regs))
    return M.exact_matches(RV.matchable(sup), "NORMALIZED_SUPPLIER", reg, key)


def _candidates(spark, sf, match_type):
    sup, regs = _sup_regs(spark, sf, match_type)
    reg, key = P.register_for(match_type, P.matchable_registers(regs))
    return M.candidate_pairs(RV.matchable(sup), "NORMALIZED_SUPPLIER", reg, key)


def q_match_candidates(spark, sf):
    return _candidates(spark, sf, "ch").select("s", "r", "choice_ord", "inter", "jaccard")


def q_match_candidates_gram(spark, sf):
    sup, regs = _sup_regs(spark, sf, "ch")
    reg, key = P.register_for("ch", P.matchable_registers(regs))
    found = G.candidate_pairs_by_grams(RV.matchable(sup), "NORMALIZED_SUPPLIER", reg, key)
    return found.withColumn("similarity", F.round("similarity", 9))


def q_pair_token_jaccard(spark, sf):
    return _candidates(spark, sf, "spine").select("s", "r", "jaccard")


def q_pair_levenshtein(spark, sf):
    c = _candidates(spark, sf, "ch")
    return c.select("s", "r", M.levenshtein_similarity(F.col("s"), F.col("r")).alias("sim"))


def q_pair_token_sort(spark, sf):
    c = _candidates(spark, sf, "ch")
    return c.select("s", "r", M.token_sort_similarity(F.col("s"), F.col("r")).alias("sim"))


def q_pair_token_set(spark, sf):
    c = _candidates(spark, sf, "ch")
    return c.select("s", "r", M.token_set_similarity(F.col("s"), F.col("r")).alias("sim"))


def make_top5(match_type, scorer):
    def q(spark, sf):
        sup, regs = _sup_regs(spark, sf, match_type)
        return P.matches(sup, regs, match_type, scorer=scorer).drop("match_type")
    return q


def q_matches_all(spark, sf):
    sup, regs = _sup_regs(spark, sf)
    parts = [P.matches(sup, regs, mt) for mt in P.MATCH_TYPES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_matches_wide(spark, sf):
    sup, regs = _sup_regs(spark, sf, "ch")
    return M.wide(P.matches(sup, regs, "ch"), "ch")


def q_unnormalise(spark, sf):
    sup, regs = _sup_regs(spark, sf, "ch")
    long = P.matches(sup, regs, "ch", with_names=True)
    return RV.unnormalise(long, "CompanyName").drop("match_type")


def q_review_wide(spark, sf):
    sup, regs = _sup_regs(spark, sf)
    return _suppliers_flat_review(P.review_wide(sup, regs))


def _suppliers_flat_review(df: DataFrame) -> DataFrame:
    cols = []
    for c in RV.review_columns():
        if c in ("dept", "contractsfinder_region"):
            cols.append(list_text(F.col(c)).alias(c))
        elif c == "PAYMENT_TOTAL_AMOUNT":
            cols.append(cents(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def q_match_bands(spark, sf):
    return RV.match_bands(q_matches_all(spark, sf)).withColumn("avg_score", F.round("avg_score", 6))


def q_match_histogram(spark, sf):
    return RV.match_histogram(q_matches_all(spark, sf)).withColumn("avg_margin", F.round("avg_margin", 6))


SPARK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_counts": q_feed_counts,
    "feed_nhs": q_feed_nhs,
    "feed_awards": q_feed_awards,
    "payments_union": q_payments_union,
    "supplier_clean": q_supplier_clean,
    "filter_numeric": q_filter_numeric,
    "html_text": q_html_text,
    "pages_text": q_pages_text,
    "parse_mixed_date": q_parse_mixed_date,
    "parse_ymd": q_parse_ymd,
    "org_counter": q_org_counter,
    "drop_audit": q_drop_audit,
    "payments_clean": q_payments_clean,
    "payments_output": q_payments_output,
    "normalise_name": q_normalise_name,
    **{f"norm_{s}": make_norm_stage(s) for s in STAGE_NAMES if s != "finish"},
    "supplier_rollup": q_supplier_rollup,
    "supplier_lists": q_supplier_lists,
    "supplier_date_list": q_supplier_date_list,
    "date_range": q_date_range,
    "suppliers": q_suppliers,
    "suppliers_script": q_suppliers_script,
    "suppliers_by_spend": q_suppliers_by_spend,
    "supplier_identity": q_supplier_identity,
    "register_snapshot_merge": q_register_snapshot_merge,
    "register_company": q_register_company,
    "register_spine": q_register_spine,
    "register_nhs": q_register_nhs,
    "register_asof_split": q_register_asof_split,
    "exact_match": q_exact_match,
    "match_candidates": q_match_candidates,
    "match_candidates_gram": q_match_candidates_gram,
    "pair_token_jaccard": q_pair_token_jaccard,
    "pair_levenshtein": q_pair_levenshtein,
    "pair_token_sort": q_pair_token_sort,
    "pair_token_set": q_pair_token_set,
    "fuzzy_top5_jaccard": make_top5("ch", "jaccard"),
    "fuzzy_top5_lev": make_top5("ch", "levenshtein"),
    "fuzzy_top5_spine_notclosed": make_top5("spine_notclosed2010", "jaccard"),
    "fuzzy_top5_spine_closed": make_top5("spine_closed2010", "jaccard"),
    "fuzzy_top5_nhs": make_top5("nhsdigital", "jaccard"),
    "matches_all": q_matches_all,
    "matches_wide": q_matches_wide,
    "unnormalise": q_unnormalise,
    "review_wide": q_review_wide,
    "match_bands": q_match_bands,
    "match_histogram": q_match_histogram,
}


# -- DuckDB oracle ----------------------------------------------------------------------------
def _union_sql(final: str) -> str:
    return O.with_ctes(O.feeds_ctes(), final)


KEYS_SQL = ", ".join(f"row_ord.{k} AS {k}" for k in KEYS)
NHS_FEED_COLS = ", ".join(f"NHSSpend_{c}" for c in O.NHS_IDS)


def _names_sql() -> str:
    from ..sources.fixtures import duckdb_fixture
    return (f"SELECT DISTINCT name FROM (SELECT supplier AS name FROM ({duckdb_fixture('payments')}) "
            f"UNION ALL SELECT CompanyName FROM ({duckdb_fixture('company')}) "
            f"UNION ALL SELECT organisationname FROM ({duckdb_fixture('spine')}) "
            f"UNION ALL SELECT NHSDigital_Supplier FROM ({duckdb_fixture('nhslist')})) WHERE name IS NOT NULL")


def _norm_stage_sql(stage):
    return O.normalise_rel(_names_sql(), "name", "normalised", last_stage=stage)


def _sup(final: str, profile: str = "notebook") -> str:
    return O.with_ctes(O.supplier_ctes(profile), final)


def _full(final: str, extra: list | None = None) -> str:
    return O.with_ctes(O.supplier_ctes() + O.register_ctes() + (extra or []), final)


def _top5_sql(match_type, scorer):
    return _full("SELECT s AS NORMALIZED_SUPPLIER, CAST(rank AS INTEGER) AS rank, r AS match, score, choice_ord "
                 "FROM m_top", O.match_ctes(match_type, scorer, 0.0 if scorer == "jaccard" else None))


def _matches_all_sql():
    ctes, parts = [], []
    for i, mt in enumerate(P.MATCH_TYPES):
        ctes += O.match_ctes(mt, "jaccard", 0.0, prefix=f"m{i}")
        parts.append(f"SELECT '{mt}' AS match_type, s AS NORMALIZED_SUPPLIER, CAST(rank AS INTEGER) AS rank, "
                     f"r AS match, score, choice_ord FROM m{i}_top")
    return ctes, " UNION ALL ".join(parts)


def _review_sql():
    ctes, selects, joins = [], [], []
    for t in RV.REVIEW_TYPES:
        rel, key, name = O.REG_KEYS[t]
        ctes += O.match_ctes(t, "jaccard", 0.0, prefix=f"m_{t}")
        ctes.append((f"names_{t}", f"SELECT {key} AS match, arg_min({name}, choice_ord) AS notnormalised "
                                   f"FROM {rel} GROUP BY {key}"))
        aggs = []
        for i in range(1, 6):
            base = f"best_{t}_match_{i}"
            aggs += [f"max(CASE WHEN rank = {i} THEN r END) AS {base}",
                     f"CAST(max(CASE WHEN rank = {i} THEN score END) AS DOUBLE) AS {base}_score",
                     f"max(CASE WHEN rank = {i} THEN notnormalised END) AS {base}_notnormalised"]
        ctes.append((f"wide_{t}", f"SELECT s AS NORMALIZED_SUPPLIER, {', '.join(aggs)} FROM m_{t}_top m "
                                  f"LEFT JOIN names_{t} n ON n.match = m.r GROUP BY s"))
        joins.append(f"LEFT JOIN wide_{t} USING (NORMALIZED_SUPPLIER)")
    verified = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in RV.VERIFIED_COLUMNS)
    match_cols = [c for c in RV.review_columns() if c.startswith("best_")]
    final = (f"SELECT sp.*, {verified}, {', '.join(match_cols)} FROM "
             "(SELECT * FROM suppliers WHERE NORMALIZED_SUPPLIER IS NOT NULL AND NORMALIZED_SUPPLIER <> '') sp "
             + " ".join(joins))
    return _full(final, ctes)


def oracle_sql() -> dict[str, str]:
    band = ("CASE WHEN score >= 100 THEN 'exact' WHEN score >= 90 THEN 'strong' "
            "WHEN score >= 70 THEN 'medium' ELSE 'weak' END")
    all_ctes, all_final = _matches_all_sql()
    sql = {
        "feed_counts": _union_sql("SELECT data_source, count(*) AS n_rows, round(sum(amount), 2) AS amount "
                                  "FROM payments_union GROUP BY data_source"),
        "feed_nhs": _union_sql(f"SELECT data_source, amount, supplier, date, dept, {NHS_FEED_COLS} FROM nhs"),
        "feed_awards": _union_sql("SELECT data_source, amount, supplier, date, dept, "
                                  "contractsfinder_awardedToVcse, contractsfinder_region FROM contracts"),
        "payments_union": _union_sql(
            f"SELECT data_source, amount, supplier AS SUPPLIER, date, dept, {NHS_FEED_COLS}, "
            "contractsfinder_awardedToVcse, contractsfinder_region FROM payments_union"),
        "supplier_clean": _union_sql(f"SELECT {KEYS_SQL}, {O.supplier_clean('supplier')} AS SUPPLIER "
                                     "FROM payments_union"),
        "filter_numeric": _union_sql(f"SELECT {KEYS_SQL}, S AS SUPPLIER FROM (SELECT *, "
                                     f"{O.supplier_clean('supplier')} AS S FROM payments_union) "
                                     f"WHERE {O.is_numeric('S')}"),
        "html_text": _union_sql(f"SELECT {KEYS_SQL}, {O.strip_html(O.supplier_clean('supplier'))} AS text "
                                "FROM payments_union"),
        "pages_text": f"SELECT page_id, {O.strip_html('html')} AS text FROM pages",
        "parse_mixed_date": _union_sql(f"SELECT {KEYS_SQL}, date AS date_text, "
                                       f"{O.fmt_dmy(O.parse_mixed_date('date'))} AS date FROM payments_union"),
        "parse_ymd": _union_sql(f"SELECT {KEYS_SQL}, date_text, CASE WHEN regexp_matches(date_text, '^\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}$') "
                                "THEN strftime(CAST(try_strptime(date_text, '%Y/%m/%d') AS DATE), '%Y-%m-%d') END AS date "
                                "FROM (SELECT *, replace(date, '-', '/') AS date_text FROM payments_union)"),
        "org_counter": _union_sql(f"SELECT {KEYS_SQL}, {O.org_name('S')} AS org_name, {O.org_n('S')} AS org_n "
                                  f"FROM (SELECT *, {O.strip_html(O.supplier_clean('supplier'))} AS S "
                                  "FROM payments_union) WHERE S IS NOT NULL"),
        "drop_audit": O.with_ctes(O.clean_ctes(), "SELECT coalesce(drop_reason, 'kept') AS reason, "
                                                  "count(*) AS n_rows FROM annot GROUP BY ALL"),
        "payments_clean": O.with_ctes(O.clean_ctes(), f"SELECT {KEYS_SQL}, SUPPLIER, SUPPLIER_TEXT, ORG_COUNT, "
                                      "date, amount, dept, contractsfinder_awardedToVcse, "
                                      "contractsfinder_region, NHSSpend_CompanyNumber, NHSSpend_CharityRegNo, "
                                      "NHSSpend_CharitySubNo FROM clean"),
        "payments_output": O.with_ctes(
            O.clean_ctes() + [("row_names!", O.normalise_rel("SELECT DISTINCT SUPPLIER_TEXT FROM clean",
                                                            "SUPPLIER_TEXT", "NORMALIZED_SUPPLIER"))],
            f"SELECT {KEYS_SQL}, {O.quote_escape('SUPPLIER')} AS SUPPLIER, NORMALIZED_SUPPLIER, ORG_COUNT, "
            f"date, amount, dept, {', '.join(OUTPUT_REST)} FROM clean LEFT JOIN row_names USING (SUPPLIER_TEXT)"),
        "normalise_name": O.normalise_rel(_names_sql(), "name", "normalised"),
        **{f"norm_{s}": _norm_stage_sql(s) for s in STAGE_NAMES if s != "finish"},
        "supplier_rollup": _sup("SELECT SUPPLIER, round(PAYMENT_TOTAL_AMOUNT, 2) AS PAYMENT_TOTAL_AMOUNT, "
                                "PAYMENT_TOTAL_COUNT FROM rolled"),
        "supplier_lists": _sup("SELECT SUPPLIER, dept_txt AS dept_list, region_txt AS region_list, "
                               "vcse_txt AS vcse_list FROM rolled_l"),
        "supplier_date_list": O.with_ctes(O.clean_ctes(), f"SELECT SUPPLIER, {O.list_text('date', 'o, date')} AS date_list FROM ("
                                          "SELECT SUPPLIER, date, min(row_ord) AS o FROM clean GROUP BY ALL) GROUP BY SUPPLIER"),
        "date_range": _sup("SELECT SUPPLIER, CASE WHEN min_date IS NULL THEN '' WHEN min_date = max_date THEN "
                           f"{O.fmt_dmy('min_date')} ELSE {O.fmt_dmy('min_date')} || '-' || "
                           f"{O.fmt_dmy('max_date')} END AS date FROM rolled"),
        "suppliers": _sup("SELECT * FROM suppliers"),
        "suppliers_script": _sup("SELECT * FROM suppliers", profile="script"),
        "suppliers_by_spend": _sup("SELECT * FROM suppliers ORDER BY PAYMENT_TOTAL_AMOUNT DESC NULLS LAST, SUPPLIER"),
        "supplier_identity": _sup("SELECT SUPPLIER, NHSSpend_CompanyNumber, NHSSpend_CharityRegNo, "
                                  "NHSSpend_CharitySubNo FROM suppliers"),
        "register_snapshot_merge": O.with_ctes(O.register_ctes(), "SELECT CompanyNumber, r.CompanyName AS CompanyName, "
                                               "r.PostTown AS PostTown, r.PostCode AS PostCode, "
                                               "r.choice_ord AS choice_ord FROM company_first"),
        "register_company": O.with_ctes(O.register_ctes(), "SELECT * FROM reg_ch"),
        "register_spine": O.with_ctes(O.register_ctes(), "SELECT * REPLACE (strftime(removeddate, '%Y-%m-%d') "
                                                         "AS removeddate) FROM reg_spine"),
        "register_nhs": O.with_ctes(O.register_ctes(), "SELECT * FROM reg_nhsdigital"),
        "register_asof_split": O.with_ctes(O.register_ctes(), "SELECT uid, strftime(removeddate, '%Y-%m-%d') AS removeddate, "
                                           "coalesce(removeddate <= DATE '2010-01-01', false) AS closed2010 "
                                           "FROM reg_spine"),
        "exact_match": _full("SELECT DISTINCT s.NORMALIZED_SUPPLIER, r.choice_ord FROM suppliers s "
                             "JOIN reg_ch r ON r.NORMALIZED_CompanyName = s.NORMALIZED_SUPPLIER "
                             "WHERE s.NORMALIZED_SUPPLIER <> ''"),
        "match_candidates": _full("SELECT s, r, choice_ord, inter, jaccard FROM m_cand",
                                  O.match_ctes("ch", "jaccard")),
        "match_candidates_gram": _full(
            f"SELECT s, r, choice_ord, inter, round(inter / (n + m - inter), 9) AS similarity FROM ("
            "SELECT s, r, choice_ord, len(x) AS n, len(y) AS m, CASE WHEN least(len(x), len(y)) >= 0.699 * greatest(len(x), len(y)) "
            f"THEN len(list_intersect(x, y)) ELSE 0 END AS inter FROM gl, gr) WHERE inter / (n + m - inter) >= {G.DEFAULT_MIN_SIMILARITY - 1e-9!r}",
            [("gl!", f"SELECT s, {O.gram_list('s')} AS x FROM (SELECT DISTINCT NORMALIZED_SUPPLIER AS s FROM suppliers) WHERE s <> ''"),
             ("gr!", f"SELECT r, choice_ord, {O.gram_list('r')} AS y FROM ({O.register_rel('ch')[0]})")]),
        "pair_token_jaccard": _full("SELECT s, r, jaccard FROM m_cand", O.match_ctes("spine", "jaccard")),
        "pair_levenshtein": _full("SELECT s, r, CASE WHEN greatest(length(s), length(r)) = 0 THEN 1.0 ELSE "
                                  "1.0 - levenshtein(s, r) / greatest(length(s), length(r)) END AS sim FROM m_cand",
                                  O.match_ctes("ch", "jaccard")),
        "pair_token_sort": _full(f"SELECT s, r, {O.levenshtein('sa', 'ra')} AS sim FROM (SELECT s, r, {O.token_sorted('s')} AS sa, "
                                 f"{O.token_sorted('r')} AS ra FROM m_cand)", O.match_ctes("ch", "jaccard")),
        "pair_token_set": _full(
            f"SELECT s, r, greatest({O.levenshtein('b', 'l')}, {O.levenshtein('b', 'q')}, {O.levenshtein('l', 'q')}) AS sim "
            "FROM (SELECT s, r, array_to_string(i, ' ') AS b, array_to_string(i || list_sort(list_filter(x, lambda t: NOT list_contains(y, t))), ' ') AS l, "
            "array_to_string(i || list_sort(list_filter(y, lambda t: NOT list_contains(x, t))), ' ') AS q "
            "FROM (SELECT *, list_sort(list_filter(x, lambda t: list_contains(y, t))) AS i FROM (SELECT s, r, "
            f"{O.token_list('s')} AS x, {O.token_list('r')} AS y FROM m_cand)))", O.match_ctes("ch", "jaccard")),
        "fuzzy_top5_jaccard": _top5_sql("ch", "jaccard"),
        "fuzzy_top5_lev": _top5_sql("ch", "levenshtein"),
        "fuzzy_top5_spine_notclosed": _top5_sql("spine_notclosed2010", "jaccard"),
        "fuzzy_top5_spine_closed": _top5_sql("spine_closed2010", "jaccard"),
        "fuzzy_top5_nhs": _top5_sql("nhsdigital", "jaccard"),
        "matches_all": _full(all_final, all_ctes),
        "matches_wide": _full("SELECT s AS NORMALIZED_SUPPLIER, " + ", ".join(
            f"max(CASE WHEN rank = {i} THEN r END) AS best_ch_match_{i}, "
            f"CAST(max(CASE WHEN rank = {i} THEN score END) AS DOUBLE) AS best_ch_match_{i}_score"
            for i in range(1, 6))
            + " FROM m_top GROUP BY s", O.match_ctes("ch", "jaccard", 0.0)),
        "unnormalise": _full("SELECT m.r AS match, s AS NORMALIZED_SUPPLIER, CAST(rank AS INTEGER) AS rank, score, "
                             "m.choice_ord, n.notnormalised FROM m_top m LEFT JOIN "
                             "(SELECT NORMALIZED_CompanyName AS match, arg_min(CompanyName, choice_ord) AS notnormalised "
                             "FROM reg_ch GROUP BY NORMALIZED_CompanyName) n ON n.match = m.r",
                             O.match_ctes("ch", "jaccard", 0.0)),
        "review_wide": _review_sql(),
        "match_bands": _full(f"SELECT match_type, {band} AS band, count(*) AS n_suppliers, "
                             "round(avg(score), 6) AS avg_score FROM (" + all_final + ") WHERE rank = 1 GROUP BY ALL",
                             all_ctes),
        "match_histogram": _full(
            "SELECT a.match_type, CAST(least(a.score // 10, 10) + 1 AS INTEGER) AS bucket, count(*) AS n_suppliers, "
            "count(*) FILTER (b.score IS NULL) AS n_alone, min(a.score - coalesce(b.score, 0)) AS min_margin, "
            "max(a.score - coalesce(b.score, 0)) AS max_margin, round(avg(a.score - coalesce(b.score, 0)), 6) AS avg_margin "
            f"FROM (SELECT * FROM ({all_final}) WHERE rank = 1) a LEFT JOIN (SELECT * FROM ({all_final}) WHERE rank = 2) b "
            "USING (match_type, NORMALIZED_SUPPLIER) GROUP BY ALL", all_ctes),
    }
    return sql
