"""Scalar text functions on supplier names, all native Spark expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R

# Characters Python's str.strip() treats as white space (ASCII controls
# 0x09-0x0D and 0x1C-0x1F, space, NEL, NBSP and the Unicode space separators):
# those of ``normalise.WS_CLASS``.
PY_WS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
         + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(col: Column) -> Column:
    """Strip leading/trailing white space the way Python's str.strip() does."""
    return F.trim(col, F.lit(PY_WS))


def supplier_clean(col: Column) -> Column:
    """upper-case then strip."""
    return py_strip(F.upper(col))


# Text that pandas.to_numeric accepts as a number (decimal, exponent,
# infinity; case-insensitive, surrounding blanks allowed).  'NAN' parses to
# NaN and therefore does not count as numeric.
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def is_numeric_text(col: Column) -> Column:
    """True when the supplier name is really a number."""
    return col.rlike(NUMERIC_TEXT)


def is_redacted(col: Column) -> Column:
    """Name contains any redaction phrase (case-sensitive substring)."""
    cond = F.lit(False)
    for phrase in R.REDACTION_PHRASES:
        cond = cond | col.contains(phrase)
    return cond


def quote_escape(col: Column) -> Column:
    """Double quote -> [DQ]."""
    return F.replace(col, F.lit('"'), F.lit("[DQ]"))


# -- F5: HTML to text --------------------------------------------------------
# One pass over the text takes each piece of markup where it starts: a comment
# (to the end if it is left open), a script or style element with its body, a
# tag whose quoted attributes may hold '>', and what else begins like a tag
# (declarations, tags with an odd quote).  The text between them is then
# decoded in one pass, so a decoded '<' is never taken for a tag and '&amp;lt;'
# yields '&lt;'.  Quantifiers are possessive: no backtracking, no deep recursion.
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
HTML_MARKUP = (r"(?is)<!--.*?(?:-->|\z)"
               rf"|<(script|style)(?=[\t-\r />]){_ATTRIBUTES}>.*?(?:</\1(?=[\t-\r />])[^>]*+>|\z)"
               rf"|</?[a-z]{_ATTRIBUTES}>"
               r"|<[/!?a-z][^>]*+>")
HTML_CODE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _entities() -> Column:
    """Named characters of HTML 5, and the numbers 128 to 159, which HTML reads as Windows-1252, as a map."""
    table = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
    for n in range(128, 160):
        table[f"#{n}"] = bytes([n]).decode("cp1252", errors="ignore") or chr(n)
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def strip_html(col: Column) -> Column:
    """The text of an HTML fragment; text without ``<``, or ``&`` with ``;``, is left alone.

    An unknown name stays as it is written; a number that is no character
    becomes U+FFFD.
    """
    # bound by a lambda, so that the pass over markup runs once
    bare = F.when(col.contains("<"), F.regexp_replace(col, HTML_MARKUP, "")).otherwise(col)
    text = F.get(F.transform(F.array(bare), lambda t: F.when(t.contains("&") & t.contains(";"), _decoded(t)).otherwise(t)), F.lit(0))
    return F.when(col.contains("<") | (col.contains("&") & col.contains(";")), text).otherwise(col)


def _decoded(s: Column) -> Column:
    """``s`` with its named and numbered characters in place."""
    table = _entities()

    def char(c: Column) -> Column:
        name = F.substring(c, F.lit(2), F.length(c) - 2)
        n = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, F.lit(3), F.length(name) - 2), 16, 10)).otherwise(
            F.substring(name, F.lit(2), F.length(name) - 1)).try_cast("int")
        valid = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, n).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        common = F.when(c == "&amp;", "&").when(c == "&lt;", "<").when(c == "&gt;", ">").when(c == "&quot;", '"')
        return (F.when(c.isin("&amp;", "&lt;", "&gt;", "&quot;"), common)  # without a search of the whole table
                .when(~name.startswith("#"), F.coalesce(F.try_element_at(table, name), c))
                .when(n.between(128, 159), F.try_element_at(table, F.concat(F.lit("#"), n.cast("string"))))
                .otherwise(point))

    codes = F.transform(F.regexp_extract_all(s, F.lit(HTML_CODE), F.lit(0)), char)
    return F.array_join(F.zip_with(F.split(s, HTML_CODE, -1), codes, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


# -- F4: organisation counter ------------------------------------------------
def org_parts(col: Column) -> Column:
    """Distinct upper-cased comma parts whose stripped length is at least 4."""
    parts = F.filter(F.transform(F.split(col, ","), py_strip), lambda p: F.length(p) >= 4)
    return F.array_distinct(F.transform(parts, F.upper))


def with_org(df: DataFrame, src: str, name: str, n: str) -> DataFrame:
    """Adds ``name`` and ``n`` of ``org_counter`` as columns; the comma parts are made once, and only of texts with a comma."""
    parts, col = F.col("__parts"), F.col(src)
    df = df.withColumn("__parts", F.when(col.contains(","), org_parts(col)))
    return df.withColumns({
        name: F.when(parts.isNull(), F.upper(col)).when(F.size(parts) == 1, parts[0]).otherwise(col),
        n: F.when(parts.isNull(), F.lit(1)).otherwise(F.size(parts)).cast("int")}).drop("__parts")


def org_counter(col: Column) -> Column:
    """F4 -> struct<name string, n int>.

    No comma: (upper(name), 1).  Otherwise the distinct long parts decide:
    exactly one -> (that part, 1); else (name unchanged, number of parts).
    """
    parts = org_parts(col)
    n = F.size(parts)
    has_comma = col.contains(",")
    name = (F.when(~has_comma, F.upper(col))
            .when(n == 1, parts[0])
            .otherwise(col))
    count = F.when(~has_comma, F.lit(1)).when(n == 1, F.lit(1)).otherwise(n)
    return F.struct(name.alias("name"), count.cast("int").alias("n"))
