"""DuckDB SQL for the correctness oracle.

Each builder returns plain SQL over the driver's pre-registered tables that
computes, by brute force where that is simplest, what the Spark query of the
same key computes.  Fixture derivations and the normaliser's step program
are generated from the same text and rule data the Spark side uses; the
scalar functions below restate the Spark expressions in DuckDB's dialect
(RE2 regular expressions, ``strptime`` formats).
"""

from __future__ import annotations

import html.entities

from ..functions import rules as R
from ..functions.normalise import DUCKDB, WS_CLASS, normalise_sql
from ..functions.text import NUMERIC_TEXT
from ..operators.matching import DEFAULT_MIN_SIMILARITY
from ..sources.fixtures import duckdb_fixture

lit = DUCKDB.lit


# -- scalar functions ---------------------------------------------------------------
def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS_CLASS + '+|' + WS_CLASS + '+' + chr(92) + 'z')}, '', 'g')"


def supplier_clean(x: str) -> str:
    return py_strip(f"upper({x})")


def is_numeric(x: str) -> str:
    return f"regexp_matches({x}, {lit(NUMERIC_TEXT)})"


def _html_names() -> str:
    """A DuckDB map of HTML's named characters and of the numbers that it reads as Windows-1252."""
    undefined = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
    entries = [(k.removesuffix(";"), v) for k, v in sorted(html.entities.html5.items()) if k.endswith(";")]
    entries += [(f"#{n}", chr(n) if n in undefined else bytes([n]).decode("cp1252")) for n in range(0x80, 0xA0)]
    return "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in entries) + "}"


def strip_html(x: str) -> str:
    """Restated for RE2, which has neither look-ahead nor back references."""
    inside = """([^>"']|"[^"]*"|'[^']*')*"""
    body = r"<{0}([\t-\r /]" + inside + r")?>.*?(</{0}([\t-\r /][^>]*)?>|\z)"
    markup = "|".join([r"<!--.*?(-->|\z)", body.format("script"), body.format("style"), "</?[a-z]" + inside + ">", "<[/!?a-z][^>]*>"])
    bare = f"regexp_replace({x}, {lit('(?is)' + markup)}, '', 'g')"
    code = lit("&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
    number = "try_cast(CASE WHEN c[3] IN ('x', 'X') THEN '0x' || c[4:-2] ELSE c[3:-2] END AS INTEGER)"
    names = _html_names()
    char = (f"CASE WHEN c[2] <> '#' THEN coalesce({names}[c[2:-2]], c) WHEN {number} BETWEEN 128 AND 159 THEN {names}['#' || {number}] "
            f"WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr({number}) ELSE '\ufffd' END")
    decoded = (f"array_to_string(list_transform(list_zip(string_split_regex(t, {code}), list_transform("
               f"regexp_extract_all(t, {code}), lambda c: {char})), lambda p: p[1] || coalesce(p[2], '')), '')")
    return f"list_transform([{bare}], lambda t: CASE WHEN contains(t, '&') THEN {decoded} ELSE t END)[1]"


def quote_escape(x: str) -> str:
    return f"replace({x}, '\"', '[DQ]')"


DUCK_MONTH_FIRST = ["%m/%d/%Y", "%d/%m/%Y"]
DUCK_DAY_FIRST = ["%d/%m/%Y"]
DUCK_NAMED = [(r"^\d{1,2} [A-Za-z]{3} \d{4}$", "%d %b %Y"), (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "%d %B %Y"),
              (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "%b %d %Y"), (r"^[A-Za-z]{4,9} \d{1,2} \d{4}$", "%B %d %Y")]
DUCK_YEAR_FIRST = [(r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"), (r"^\d{8}$", "%Y%m%d"), (r"^\d{4}$", "%Y")]


def _parse_date(x: str, numeric: list[str]) -> str:
    """Without a time, with four-digit years, first format that parses."""
    x = (rf"regexp_replace(trim({x}), '[ T]+\d{{1,2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-]\d{{2}}:?\d{{2}}))?$', '')")
    slashed = rf"regexp_replace({x}, '^(\d+)[-./](\d+)[-./](\d+)$', '\1/\2/\3')"
    named = rf"regexp_replace({x}, '[-./, ]+', ' ', 'g')"
    wide = [rf"regexp_replace(regexp_replace({y}, '^(.*[^0-9])([0-6]\d)$', '\g20\2'), '^(.*[^0-9])([7-9]\d)$', '\g19\2')".replace(
        r"\g", r"\1") for y in (slashed, named)]
    tries = [f"CASE WHEN regexp_matches({wide[0]}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime({wide[0]}, {lit(f)}) END"
             for f in numeric]
    tries += [f"CASE WHEN regexp_matches({slashed}, {lit(shape)}) THEN try_strptime({slashed}, {lit(f)}) END"
              for shape, f in DUCK_YEAR_FIRST]
    tries += [f"CASE WHEN regexp_matches({wide[1]}, {lit(shape)}) THEN try_strptime({wide[1]}, {lit(f)}) END"
              for shape, f in DUCK_NAMED]
    return f"CAST(coalesce({', '.join(tries)}) AS DATE)"


def parse_mixed_date(x: str) -> str:
    return _parse_date(f"split_part(CAST({x} AS VARCHAR), 'T', 1)", DUCK_MONTH_FIRST)


def parse_dayfirst(x: str) -> str:
    return _parse_date(x, DUCK_DAY_FIRST)


def fmt_dmy(x: str) -> str:
    return f"strftime({x}, '%d-%m-%Y')"


def org_parts(x: str) -> str:
    kept = f"list_filter(string_split({x}, ','), lambda p: length({py_strip('p')}) >= 4)"
    return f"list_distinct(list_transform({kept}, lambda p: upper({py_strip('p')})))"


def org_name(x: str) -> str:
    parts = org_parts(x)
    return (f"CASE WHEN NOT contains({x}, ',') THEN upper({x}) "
            f"WHEN len({parts}) = 1 THEN ({parts})[1] ELSE {x} END")


def org_n(x: str) -> str:
    return (f"CAST(CASE WHEN NOT contains({x}, ',') THEN 1 "
            f"WHEN len({org_parts(x)}) = 1 THEN 1 ELSE len({org_parts(x)}) END AS INTEGER)")


def is_redacted(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(p)})" for p in R.REDACTION_PHRASES) + ")"


def normalise_rel(rel: str, src: str, dst: str, last_stage: str | None = None) -> str:
    """Relation ``rel`` plus column ``dst`` = normalised ``src``."""
    if src == dst:
        q = f"SELECT * REPLACE (CAST({src} AS VARCHAR) AS {dst}) FROM ({rel})"
    else:
        q = f"SELECT *, CAST({src} AS VARCHAR) AS {dst} FROM ({rel})"
    for expr in normalise_sql(dst, DUCKDB, last_stage):
        q = f"SELECT * REPLACE ({expr} AS {dst}) FROM ({q})"
    return q


def token_list(x: str) -> str:
    processed = f"trim(lower(regexp_replace({x}, '[^A-Za-z0-9]', ' ', 'g')))"
    return f"list_distinct(list_filter(string_split({processed}, ' '), lambda t: t <> ''))"


def gram_list(x: str) -> str:
    return f"list_distinct(list_transform(range(1, length({x}) + 2), lambda i: substring('  ' || {x} || ' ', i, 3)))"


def list_text(values: str, order: str) -> str:
    """Aggregate: values joined with '|' in ``order``; missing as 'NULL'."""
    return f"string_agg(coalesce(CAST({values} AS VARCHAR), 'NULL'), '|' ORDER BY {order})"


# -- relations (CTE bodies) -------------------------------------------------------------
ORD = "{'feed_ord': CAST(feed_ord AS BIGINT), 'k1': CAST(k1 AS BIGINT), 'k2': CAST(k2 AS BIGINT), 'k3': CAST(k3 AS BIGINT), 'k4': CAST(k4 AS BIGINT)}"
NHS_IDS = ["CompanyName", "CompanyNumber", "CharityRegNo", "CharitySubNo", "CharityNameNo",
           "CharityName", "audit_type", "CHnotes", "CCnotes", "isCIC"]


def feeds_ctes() -> list[tuple[str, str]]:
    nhs_cols = ", ".join(f"{c} AS NHSSpend_{c}" for c in NHS_IDS)
    return [
        ("nhs", f"SELECT data_source, amount, supplier, date, dept, {nhs_cols}, {ORD} AS row_ord "
                f"FROM ({duckdb_fixture('nhs')})"),
        ("centgov", f"SELECT data_source, amount, supplier, date, dept, {ORD} AS row_ord "
                    f"FROM ({duckdb_fixture('centgov')})"),
        ("contracts", "SELECT data_source, awardedValue AS amount, awardedSupplier AS supplier, "
                      "awardedDate AS date, organisationName AS dept, "
                      "CAST(awardedToVcse AS BOOLEAN) AS contractsfinder_awardedToVcse, "
                      f"region AS contractsfinder_region, {ORD} AS row_ord "
                      f"FROM ({duckdb_fixture('contracts')})"),
        ("payments_union", "SELECT * FROM nhs UNION ALL BY NAME SELECT * FROM centgov "
                           "UNION ALL BY NAME SELECT * FROM contracts"),
    ]


def clean_ctes() -> list[tuple[str, str]]:
    a3 = ("SELECT *, " + parse_mixed_date("date") + " AS pay_date, "
          "CASE WHEN length(S) <= 3 THEN S END AS short_text FROM a2")
    return feeds_ctes() + [
        ("a1", f"SELECT *, {supplier_clean('supplier')} AS S0 FROM payments_union"),
        ("a2", f"SELECT *, {is_numeric('S0')} AS is_numeric, {strip_html('S0')} AS S FROM a1"),
        ("a3", a3),
        ("a4!", normalise_rel("SELECT * FROM a3", "short_text", "short_norm")),
        ("a5", "SELECT *, coalesce(length(S) <= 3 AND length(short_norm) <= 3, false) AS is_short, "
               f"{org_name('S')} AS org_name, {org_n('S')} AS org_n FROM a4"),
        ("annot", "SELECT *, CASE WHEN S IS NULL THEN 'null_supplier' "
                  "WHEN is_numeric THEN 'numeric_supplier' "
                  "WHEN pay_date IS NULL THEN 'null_date' "
                  "WHEN amount IS NULL THEN 'null_amount' "
                  "WHEN dept IS NULL THEN 'null_dept' "
                  "WHEN is_short THEN 'short_name' "
                  f"WHEN {is_redacted('org_name')} THEN 'redacted' "
                  "WHEN org_n <> 1 THEN 'multi_org' END AS drop_reason FROM a5"),
        ("clean", "SELECT * EXCLUDE (supplier, date, S0, S, is_numeric, short_text, short_norm, "
                  "is_short, org_name, org_n, drop_reason), S AS SUPPLIER_TEXT, org_name AS SUPPLIER, "
                  f"org_n AS ORG_COUNT, {fmt_dmy('pay_date')} AS date FROM annot "
                  "WHERE drop_reason IS NULL"),
    ]


def supplier_ctes(profile: str = "notebook") -> list[tuple[str, str]]:
    rolled = ("SELECT SUPPLIER, sum(amount) AS PAYMENT_TOTAL_AMOUNT, sum(n) AS PAYMENT_TOTAL_COUNT, "
              "coalesce(bool_or(vcse), false) AS any_vcse, min(min_date) AS min_date, "
              "max(max_date) AS max_date FROM combos GROUP BY SUPPLIER")
    lists = []
    for name, col in (("dept_l", "dept"), ("region_l", "region"), ("vcse_l", "vcse")):
        lists.append((name + "_f", f"SELECT SUPPLIER, {col} AS v, min(first_ord) AS o FROM combos "
                                   f"GROUP BY SUPPLIER, {col}"))
        lists.append((name, f"SELECT SUPPLIER, {list_text('v', 'o')} AS txt, count(*) AS n_values, "
                            f"bool_and(v IS NULL) AS all_null FROM {name}_f GROUP BY SUPPLIER"))
    region = ("CASE WHEN x.region_n = 1 AND x.region_all_null THEN '' ELSE x.region_txt END"
              if profile == "notebook" else "x.region_txt")
    deptcount = ("x.dept_n" if profile == "notebook" else
                 "length(x.dept_txt) - length(replace(x.dept_txt, ';', '')) + 1")
    date_text = ("CASE WHEN x.min_date IS NULL THEN '' WHEN x.min_date = x.max_date THEN "
                 f"{fmt_dmy('x.min_date')} ELSE {fmt_dmy('x.min_date')} || '-' || {fmt_dmy('x.max_date')} END")
    return clean_ctes() + [
        ("combos", "SELECT SUPPLIER, dept, contractsfinder_region AS region, "
                   "contractsfinder_awardedToVcse AS vcse, min(row_ord) AS first_ord, "
                   "sum(amount) AS amount, count(*) AS n, min(pay_date) AS min_date, "
                   "max(pay_date) AS max_date FROM clean GROUP BY ALL"),
        ("rolled", rolled),
        *lists,
        ("rolled_l", "SELECT x.*, d.txt AS dept_txt, d.n_values AS dept_n, r.txt AS region_txt, "
                     "r.n_values AS region_n, r.all_null AS region_all_null, v.txt AS vcse_txt FROM rolled x "
                     "JOIN dept_l d ON d.SUPPLIER = x.SUPPLIER JOIN region_l r ON r.SUPPLIER = x.SUPPLIER "
                     "JOIN vcse_l v ON v.SUPPLIER = x.SUPPLIER"),
        ("rolled2", f"SELECT * REPLACE ({org_name('SUPPLIER')} AS SUPPLIER), "
                    f"{org_n('SUPPLIER')} AS ORG_COUNT FROM rolled_l"),
        ("rolled3!", normalise_rel("SELECT * FROM rolled2", "SUPPLIER", "NORMALIZED_SUPPLIER")),
        ("ids", "SELECT DISTINCT supplier AS nhs_supplier, NHSSpend_CompanyName, NHSSpend_CompanyNumber, "
                "NHSSpend_CharityName, NHSSpend_CharityRegNo, NHSSpend_CharitySubNo, "
                "NHSSpend_CharityNameNo FROM nhs"),
        ("suppliers", f"SELECT {quote_escape('x.SUPPLIER')} AS SUPPLIER, "
                      "CASE WHEN x.any_vcse THEN 'True' ELSE 'False' END AS contractsfinder_awardedToVcse, "
                      f"{region} AS contractsfinder_region, {date_text} AS date, x.dept_txt AS dept, "
                      "round(x.PAYMENT_TOTAL_AMOUNT, 2) AS PAYMENT_TOTAL_AMOUNT, x.ORG_COUNT, "
                      "x.NORMALIZED_SUPPLIER, x.PAYMENT_TOTAL_COUNT, ids.NHSSpend_CompanyNumber, "
                      "ids.NHSSpend_CharityRegNo, ids.NHSSpend_CharitySubNo, "
                      f"CAST({deptcount} AS INTEGER) AS deptcount "
                      "FROM rolled3 x LEFT JOIN ids ON x.SUPPLIER = ids.nhs_supplier WHERE x.ORG_COUNT = 1"),
    ]


def as_text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'nan')"


def register_ctes() -> list[tuple[str, str]]:
    company_first = ("SELECT CompanyNumber, arg_min({'CompanyName': CompanyName, 'PostTown': PostTown, "
                     "'PostCode': PostCode, 'choice_ord': choice_ord}, choice_ord) AS r "
                     "FROM (SELECT *, CAST(src_priority AS BIGINT) * 72057594037927936 + k1 AS choice_ord "
                     f"FROM ({duckdb_fixture('company')})) GROUP BY CompanyNumber")
    company_norm = normalise_rel(
        "SELECT CompanyNumber, r.CompanyName AS CompanyName, r.PostTown AS PostTown, "
        f"r.PostCode AS PostCode, r.choice_ord AS choice_ord, {as_text('r.CompanyName')} AS NORMALIZED_CompanyName "
        "FROM company_first", "NORMALIZED_CompanyName", "NORMALIZED_CompanyName")
    spine_norm = normalise_rel(
        "SELECT uid, organisationname, fulladdress, city, postcode, registerdate, removeddate, "
        f"CAST(k1 AS BIGINT) AS choice_ord, {as_text('organisationname')} AS NORMALIZED_organisationname "
        "FROM spine_base", "NORMALIZED_organisationname", "NORMALIZED_organisationname")
    nhs_norm = normalise_rel(
        "SELECT NHSDigital_Supplier, CAST(k1 AS BIGINT) AS choice_ord, "
        f"{as_text('NHSDigital_Supplier')} AS NORMALIZED_NHSDigital_Supplier "
        f"FROM ({duckdb_fixture('nhslist')})", "NORMALIZED_NHSDigital_Supplier",
        "NORMALIZED_NHSDigital_Supplier")

    def unique(rel, key, cols):
        struct = ", ".join(f"'{c}': {c}" for c in cols)
        picked = ", ".join(f"r.{c} AS {c}" for c in cols)
        return (f"SELECT {key}, {picked} FROM (SELECT {key}, count(*) AS n_same, "
                f"arg_min({{{struct}}}, choice_ord) AS r FROM {rel} GROUP BY {key}) WHERE n_same = 1")

    return [
        ("company_first", company_first),
        ("company_norm!", company_norm),
        ("company_u", unique("company_norm", "NORMALIZED_CompanyName",
                             ["CompanyNumber", "CompanyName", "PostTown", "PostCode", "choice_ord"])),
        ("reg_ch", f"SELECT CompanyNumber, NORMALIZED_CompanyName, {quote_escape('CompanyName')} AS CompanyName, "
                   "PostTown, PostCode, choice_ord FROM company_u"),
        ("spine_base!", duckdb_fixture("spine")),
        ("spine_norm!", spine_norm),
        ("spine_u", unique("spine_norm", "NORMALIZED_organisationname",
                           ["uid", "organisationname", "fulladdress", "city", "postcode",
                            "registerdate", "removeddate", "choice_ord"])),
        ("reg_spine", f"SELECT uid, NORMALIZED_organisationname, {quote_escape('organisationname')} AS organisationname, "
                      f"{quote_escape('fulladdress')} AS fulladdress, city, postcode, registerdate, "
                      f"{parse_dayfirst('removeddate')} AS removeddate, choice_ord FROM spine_u"),
        ("nhs_norm!", nhs_norm),
        ("nhs_u", unique("nhs_norm", "NORMALIZED_NHSDigital_Supplier", ["NHSDigital_Supplier", "choice_ord"])),
        ("reg_nhsdigital", f"SELECT {quote_escape('NHSDigital_Supplier')} AS NHSDigital_Supplier, "
                           "NORMALIZED_NHSDigital_Supplier, choice_ord FROM nhs_u"),
    ]


REG_KEYS = {"spine": ("reg_spine", "NORMALIZED_organisationname", "organisationname"),
            "ch": ("reg_ch", "NORMALIZED_CompanyName", "CompanyName"),
            "nhsdigital": ("reg_nhsdigital", "NORMALIZED_NHSDigital_Supplier", "NHSDigital_Supplier")}


def register_rel(match_type: str) -> tuple[str, str]:
    """(relation SQL, normalised-name column) for a match type."""
    base = "spine" if match_type.startswith("spine") else match_type
    rel, key, _ = REG_KEYS[base]
    cond = f"{key} <> ''"
    closed = "coalesce(removeddate <= DATE '2010-01-01', false)"
    if match_type == "spine_notclosed2010":
        cond += f" AND NOT {closed}"
    elif match_type == "spine_closed2010":
        cond += f" AND {closed}"
    return f"SELECT {key} AS r, choice_ord FROM {rel} WHERE {cond}", key


def levenshtein(a: str, b: str) -> str:
    return (f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE "
            f"1.0 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END")


def token_sorted(x: str) -> str:
    """All tokens in alphabetical order, repeats included."""
    return ("array_to_string(list_sort(list_filter(string_split(lower(regexp_replace("
            f"{x}, '[^A-Za-z0-9]', ' ', 'g')), ' '), lambda t: t <> '')), ' ')")


def match_ctes(match_type: str, scorer: str, t: float | None = DEFAULT_MIN_SIMILARITY,
               prefix: str = "m") -> list[tuple[str, str]]:
    """Brute-force token-Jaccard candidates (all pairs sharing a token),
    scored and ranked; relation ``{prefix}_top`` holds the top 5.  Edit
    distance without ``t`` scores all pairs."""
    reg, _ = register_rel(match_type)
    p = prefix
    if scorer == "levenshtein" and t is None:
        return [
            (f"{p}_l!", "SELECT DISTINCT NORMALIZED_SUPPLIER AS s FROM suppliers "
                        "WHERE NORMALIZED_SUPPLIER IS NOT NULL AND NORMALIZED_SUPPLIER <> ''"),
            (f"{p}_r!", f"SELECT r, choice_ord FROM ({reg}) WHERE r <> ''"),
            (f"{p}_scored", "SELECT s, r, choice_ord, 1.0 - CAST(levenshtein(s, r) AS DOUBLE) / greatest(length(s), length(r)) AS sim "
                            f"FROM {p}_l CROSS JOIN {p}_r"),
            (f"{p}_top", "SELECT s, r, choice_ord, sim, CAST(round(sim * 100) AS INTEGER) AS score, "
                         "row_number() OVER (PARTITION BY s ORDER BY sim DESC, choice_ord) AS rank "
                         f"FROM {p}_scored QUALIFY rank <= 5"),
        ]
    sim = {"jaccard": "jaccard",
           "levenshtein": "CASE WHEN greatest(length(s), length(r)) = 0 THEN 1.0 ELSE "
                          "1.0 - levenshtein(s, r) / greatest(length(s), length(r)) END"}[scorer]
    return [
        (f"{p}_l", "SELECT DISTINCT NORMALIZED_SUPPLIER AS s FROM suppliers "
                   "WHERE NORMALIZED_SUPPLIER IS NOT NULL AND NORMALIZED_SUPPLIER <> ''"),
        (f"{p}_le", f"SELECT s, len(toks) AS s_n, unnest(toks) AS tok FROM "
                    f"(SELECT s, {token_list('s')} AS toks FROM {p}_l) WHERE len(toks) > 0"),
        (f"{p}_r", reg),
        (f"{p}_re", f"SELECT r, choice_ord, len(toks) AS r_n, unnest(toks) AS tok FROM "
                    f"(SELECT r, choice_ord, {token_list('r')} AS toks FROM {p}_r) WHERE len(toks) > 0"),
        (f"{p}_pairs", f"SELECT s, r, any_value(choice_ord) AS choice_ord, count(*) AS inter, "
                       f"any_value(s_n) AS s_n, any_value(r_n) AS r_n FROM {p}_le JOIN {p}_re USING (tok) "
                       "GROUP BY s, r"),
        (f"{p}_cand", f"SELECT *, inter / (s_n + r_n - inter) AS jaccard FROM {p}_pairs "
                      f"WHERE inter / (s_n + r_n - inter) >= {t!r}"),
        (f"{p}_scored", f"SELECT *, {sim} AS sim FROM {p}_cand"),
        (f"{p}_top", f"SELECT s, r, choice_ord, sim, CAST(round(sim * 100) AS INTEGER) AS score, "
                     "row_number() OVER (PARTITION BY s ORDER BY sim DESC, choice_ord) AS rank "
                     f"FROM {p}_scored QUALIFY rank <= 5"),
    ]


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    seen, body = set(), []
    for name, sql in ctes:
        # A trailing '!' asks for a materialised CTE: an evaluation barrier
        # that keeps DuckDB from merging the normaliser's projections into
        # a join below them.
        materialised = name.endswith("!")
        name = name.rstrip("!")
        if name in seen:
            continue
        seen.add(name)
        kw = "MATERIALIZED " if materialised else ""
        body.append(f"{name} AS {kw}(\n{sql}\n)")
    return "WITH " + ",\n".join(body) + "\n" + final
