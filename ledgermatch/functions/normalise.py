"""Organisation-name normaliser.

The normaliser is an ordered program of small steps (see ``STEPS``).  Each
step is SQL text over one column, generated for a *dialect*: Spark SQL for
the engine, DuckDB SQL for the correctness oracle, from the same rule data.

On Spark, ``normalise_frame`` applies the steps as successive projections of
one column.  Rule tables become plain nested ``replace`` calls, which
whole-stage codegen compiles to straight-line code (about 40x faster than a
higher-order ``aggregate`` fold, which is interpreted).  Conditional steps
reference the column more than once, which keeps the optimiser from merging
the projections into one very deep expression, so no expression is deeper
than the largest rule table.

Apply it to *distinct* names and join back when names repeat.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R

# Python's str.strip() white space, written so that Java regex and RE2 both
# read it: ASCII controls 0x09-0x0D and 0x1C-0x1F, space, NEL, NBSP, and the
# Unicode space separators.
WS_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


# Of rule tables with so many entries, a name is first searched for any that applies.
MANY = 8


def any_of(finds: list[str]) -> str:
    """A pattern that is found in the texts that hold one of ``finds``; shared beginnings are tried once."""
    if "" in finds:
        return ""
    rests: dict[str, list[str]] = {}
    for find in finds:
        rests.setdefault(find[0], []).append(find[1:])
    parts = [re.escape(first) + any_of(rest) for first, rest in rests.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


class Dialect:
    name = "spark"

    def lit(self, text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def rx(self, x: str, pattern: str, repl: str) -> str:
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(repl)})"

    def rlike(self, x: str, pattern: str) -> str:
        return f"({x} RLIKE {self.lit(pattern)})"

    def contains(self, x: str, sub: str) -> str:
        return f"contains({x}, {self.lit(sub)})"

    def where_any(self, x: str, finds: list[str], then: str) -> str:
        """``then`` where ``x`` holds one of ``finds``, else ``x``: one search instead of one for each."""
        return _when(self.rlike(x, any_of(finds)), then, x) if len(finds) >= MANY else then

    def join_initials(self, x: str) -> str:
        padded = f"(' ' || {x} || ' ')"
        return f"trim({self.rx(padded, '(?<= [^ ]) (?=[^ ] )', '')})"


class DuckDialect(Dialect):
    name = "duckdb"

    def where_any(self, x: str, finds: list[str], then: str) -> str:
        return then

    def lit(self, text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def rx(self, x: str, pattern: str, repl: str) -> str:
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(repl)}, 'g')"

    def rlike(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.lit(pattern)})"

    def join_initials(self, x: str) -> str:
        # RE2 has no look-around: double every blank, mark one-character
        # tokens, delete the gap between two marks that was one blank, drop
        # the marks and halve the blanks again.
        y = f"replace(' ' || {x} || ' ', ' ', '  ')"
        y = f"regexp_replace({y}, ' ([^ ]) ', ' ' || chr(1) || '\\1' || chr(2) || ' ', 'g')"
        y = f"replace({y}, chr(2) || '  ' || chr(1), '')"
        y = f"replace(replace({y}, chr(1), ''), chr(2), '')"
        return f"trim(replace({y}, '  ', ' '))"


SPARK = Dialect()
DUCKDB = DuckDialect()


def fold_sql(x: str, pairs, d: Dialect) -> str:
    """Ordered replace-all of every (find, replace) pair, left to right.

    A name that holds none of the texts at the start is not changed by any pair.
    """
    text = x
    for a, b in pairs:
        x = f"replace({x}, {d.lit(a)}, {d.lit(b)})"
    return d.where_any(text, [a for a, _ in pairs], x)


def collapse_sql(x: str, d: Dialect) -> str:
    return d.rx(x, " +", " ")


def _when(cond: str, then: str, x: str) -> str:
    return f"(CASE WHEN {cond} THEN {then} ELSE {x} END)"


def _stripped_endswith(x: str, suffix: str, d: Dialect) -> str:
    """``x.strip().endswith(suffix)``; never true for a suffix that ends in
    white space, since a stripped text cannot end in white space."""
    if suffix != suffix.rstrip():
        return "false"
    return d.rlike(x, re.escape(suffix) + WS_CLASS + r"*\z")


def _steps():
    """The program: a list of (stage name, fn(x_sql, dialect) -> sql)."""
    steps = []

    def add(stage, fn):
        steps.append((stage, fn))

    def ltd(s):
        return lambda x, d: _when(_stripped_endswith(x, s, d), f"replace({x}, {d.lit(s)}, 'LTD ')", x)

    def all_words(words):
        return lambda x, d: _when(" AND ".join(d.contains(x, w) for w in words),
                                  f"({x} || ' PTA ')", x)

    def context(trigger, pairs):
        return lambda x, d: _when(d.contains(x, trigger), fold_sql(x, pairs, d), x)

    def ordinal(word, suffix):
        return lambda x, d: _when(d.contains(x, word), f"({x} || {d.lit(suffix)})", x)

    # Upper, `S -> 'S, pad with blanks.
    add("pad", lambda x, d: f"(' ' || replace(upper({x}), '`S', {d.lit(chr(39) + 'S')}) || ' ')")
    # Punctuation, apostrophes, spelling.
    add("punct", lambda x, d: fold_sql(x, R.PUNCTUATION, d))
    add("apostrophe", lambda x, d: collapse_sql(fold_sql(x, R.APOSTROPHES, d), d))
    add("spelling", lambda x, d: collapse_sql(fold_sql(x, R.SPELLING, d), d))
    # Suffix loop, one step per suffix (each tests the current text).
    for suffix in R.LTD_SUFFIXES:
        add("ltd", ltd(suffix))
    # Abbreviations, then only a trailing ' CO ' becomes ' COMPANY '.
    add("abbrev", lambda x, d: d.rx(fold_sql(x, R.ABBREVIATIONS, d), r" CO \z", " COMPANY "))
    # Stop words.
    add("stopwords", lambda x, d: collapse_sql(fold_sql(x, R.STOPWORDS, d), d))
    # One leading/trailing quote, non-printable-ASCII deleted, strip.
    add("ascii", lambda x, d: "trim(" + d.rx(d.rx(d.rx(x, '^"', ""), r'"\z', ""),
                                             r"[^\x20-\x7E]", "") + ")")
    # Join runs of one-character tokens.
    add("initials", lambda x, d: d.join_initials(x))
    # parent/teacher associations, community associations.
    add("pta", lambda x, d: fold_sql(f"(' ' || {x} || ' ')", R.PTA_ALIASES, d))
    add("pta", all_words([" PARENT", " TEACHER", "ASSOC "]))
    add("pta", all_words([" PARENT", " STAFF", "ASSOC "]))
    add("pta", lambda x, d: _when(d.contains(x, " PTA "), fold_sql(x, R.PTA_ROLE_WORDS, d), x))
    add("pta", lambda x, d: collapse_sql(fold_sql(x, [R.COMMUNITY_ASSOC], d), d))
    # Domain table.
    add("domain", lambda x, d: fold_sql(x, R.DOMAIN, d))
    # Context rules.
    for trigger, pairs in R.CONTEXT_RULES:
        add("context", context(trigger, pairs))
    # Ordinal words append a digit; then dST/dND/dRD/dTH -> d.
    for word, suffix in R.ORDINAL_APPEND:
        add("ordinals", ordinal(word, suffix))
    add("ordinals", lambda x, d: fold_sql(x, R.ordinal_digit_rules(), d))
    # Tail rules, collapse, drop quotes, strip, upper.
    add("tail", lambda x, d: fold_sql(x, R.TAIL, d))
    add("finish", lambda x, d: f"upper(trim(replace({collapse_sql(x, d)}, '\"', '')))")
    return steps


STEPS = _steps()
STAGE_NAMES = list(dict.fromkeys(name for name, _ in STEPS))


def steps_upto(last_stage: str | None = None):
    if last_stage is None:
        return STEPS
    if last_stage not in STAGE_NAMES:
        raise ValueError(f"unknown stage {last_stage!r}")
    stop = max(i for i, (name, _) in enumerate(STEPS) if name == last_stage)
    return STEPS[: stop + 1]


def normalise_frame(df: DataFrame, src: str, dst: str, last_stage: str | None = None) -> DataFrame:
    """Add column ``dst`` = normalised ``src`` (through ``last_stage``)."""
    out = df.withColumn(dst, F.col(src).cast("string"))
    quoted = f"`{dst}`"
    for _, step in steps_upto(last_stage):
        out = out.withColumn(dst, F.expr(step(quoted, SPARK)))
    # Optimiser barrier.  Conditional steps use their input several times;
    # a filter on the result pushed down through the steps would have the
    # input substituted into every use, step after step (exponential plan
    # growth).  Predicates are not pushed through a projection holding a
    # non-deterministic expression, so the last step carries a no-op one
    # (an empty substring of the partition id).
    return out.withColumn(dst, once(F.col(quoted)))


def once(text: Column) -> Column:
    """``text`` with the barrier of ``normalise_frame``: it is computed in its own projection, once."""
    return F.concat(text, F.substring(F.spark_partition_id().cast("string"), 1, 0))


def normalise_where(name: str, condition: str) -> Column:
    """Column ``name`` normalised where ``condition`` holds, else null, as one expression.

    Each step's input is bound by a lambda.  That runs interpreted, and rows
    without the condition cost nothing: for conditions that few rows meet.  The
    end is the optimiser barrier of ``normalise_frame``.
    """
    text = f"`{name}`"
    for _, step in STEPS:
        text = f"get(transform(array({text}), t -> {step('t', SPARK)}), 0)"
    return F.expr(f"CASE WHEN {condition} THEN concat({text}, substr(cast(spark_partition_id() AS string), 1, 0)) END")


def _sought() -> list[str]:
    """The texts that a name must hold for any step to change it, or for a conditional step to begin."""
    tables = [R.PUNCTUATION, R.APOSTROPHES, R.SPELLING, R.ABBREVIATIONS, R.STOPWORDS, R.PTA_ALIASES, [R.COMMUNITY_ASSOC], R.DOMAIN,
              R.CONTEXT_RULES, R.ORDINAL_APPEND, R.ordinal_digit_rules(), R.TAIL]
    return [find for table in tables for find, _ in table] + [s.rstrip() for s in R.LTD_SUFFIXES] + [" CO ", " PTA "]


def plain_short(name: str) -> str:
    """SQL: whether column ``name`` is one to three letters and digits that no step changes.

    Until a step changes such a name, each step sees it with or without a blank
    around it, so a step can only find texts of that shape.
    """
    found = sorted({f for f in _sought() if f and re.fullmatch(" ?[A-Z0-9]{0,3} ?", f)})
    return (f"(`{name}` RLIKE '^[A-Z0-9]{{1,3}}\\\\z' AND NOT concat(' ', `{name}`, ' ') "
            f"RLIKE {SPARK.lit('|'.join(found) or '^$')})")


def normalise_sql(x: str, d: Dialect, last_stage: str | None = None) -> list[str]:
    """The steps as a list of SQL expressions, each over the column ``x``."""
    return [step(x, d) for _, step in steps_upto(last_stage)]
