"""Quality rules as a short-circuit cascade, on built-in functions only.

Each rule is a boolean column that is true where a document is to be
rejected.  On a sample of the documents every rule's rejection rate and cost
(seconds over the sample, the better of two runs) are estimated; the rules are
then ordered by rejection per cost and nested into one conditional, so that a
document which an early rule rejects is never seen by the later ones.

The order moves work, never the verdict: a document is kept if no rule rejects
it.  The sample is taken by a hash over all rows, about ``sample_rows`` of
them, and only serves the order.

Null texts have no words and fail the length rule.  Repeated rows get the same
verdict.  Further columns pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

SAMPLE_ROWS = 2000

SPACES = r"[ \t-\r]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it and wherever the optimiser moves it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]")),
               lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def repeated_words(ws: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more; ``ws`` is a bound array of words.

    Hashes of the windows rule out most texts.  For the others the windows
    themselves are sorted with their places; equal neighbours are repeats, and
    each place covers as many words as lie before the next one, three at most.
    """
    n = F.size(ws)
    hashes = F.zip_with(F.zip_with(F.slice(ws, 1, n - 2), F.slice(ws, 2, n - 2), lambda a, b: F.xxhash64(a, b)),
                        F.slice(ws, 3, n - 2), lambda h, c: F.xxhash64(h, c))
    windows = F.sort_array(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(
        F.concat_ws(" ", F.slice(ws, i, 3)).alias("w"), i.alias("i"))))

    def places(w: Column) -> Column:
        return F.sort_array(F.filter(
            F.transform(w, lambda x, k: F.when(
                (F.get(w, k - 1)["w"] == x["w"]) | (F.get(w, k + 1)["w"] == x["w"]), x["i"])),
            lambda i: i.isNotNull()))

    def covered(i: Column) -> Column:
        steps = F.transform(i, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(i, k + 1), x + 3) - x))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    repeats = (n >= 3) & let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(repeats, let(windows, lambda w: let(places(w), covered))).otherwise(0).cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject(text, words)`` is true where a document fails."""

    name: str
    reject: Callable[[Column, Column], Column]


def few_words(text: Column, ws: Column) -> Column:
    return F.size(ws) < 50


def much_repetition(text: Column, ws: Column) -> Column:
    return 100 * repeated_words(ws) > 50 * F.size(ws)


def many_duplicate_lines(text: Column, ws: Column) -> Column:
    return 100 * duplicate_lines(text) > 50 * F.size(F.split(text, "\n"))


def odd_word_length(text: Column, ws: Column) -> Column:
    return let(word_chars(ws), lambda n: (n < 2 * F.size(ws)) | (n > 16 * F.size(ws)))


def letters(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, rf"[^\p{{{kind}}}]", ""))


#: The rules of the operator's contract.
BASE_RULES = [Rule("few_words", few_words), Rule("much_repetition", much_repetition)]

RULES = [
    Rule("symbols_per_word", lambda text, ws: symbols(text) > 0.3 * F.size(ws)),
    Rule("exclamations_per_word", lambda text, ws: F.length(text) - F.length(F.translate(text, "!", ""))
         > 0.3 * F.size(ws)),
    Rule("many_duplicate_lines", many_duplicate_lines),
    Rule("odd_word_length", odd_word_length),
    Rule("few_letters", lambda text, ws: letters(text, "L") < 0.5 * F.length(text)),
    Rule("mostly_capitals", lambda text, ws: letters(text, "Lu") > 0.5 * letters(text, "L")),
]


def sample_of(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` documents by a hash of their id and text, written to the shared folder."""
    n = docs.count()
    keep = max(1, round(1_000_000 * min(1.0, sample_rows / max(n, 1))))
    return written(docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < keep)
                   .select("doc_id", "text"), "quality-sample")


def estimate(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, rejection rate, seconds over the sample) for each rule."""
    rows = max(sample.count(), 1)
    text = text_of()
    out = []
    for rule in rules:
        seconds = []
        for _ in range(2):
            began = time.perf_counter()
            rejected = sample.select(F.count_if(let(words(text), lambda ws: rule.reject(text, ws)))).first()[0]
            seconds.append(time.perf_counter() - began)
        out.append((rule, rejected / rows, min(seconds)))
    return out


def ordered(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """By rejections per second, the highest first; ties by name."""
    return [r for r, _, _ in sorted(estimates, key=lambda e: (-e[1] / max(e[2], 1e-9), e[0].name))]


def cascade(rules: list[Rule], text: Column, ws: Column) -> Column:
    """True where some rule rejects, each rule evaluated only where the ones before did not."""
    verdict = F.lit(False)
    for rule in reversed(rules):
        verdict = F.when(rule.reject(text, ws), F.lit(True)).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document.

    The counts are wanted for all documents, so only the further rules are left to the cascade.
    """
    rules = ordered(estimate(sample_of(docs, sample_rows), RULES))
    text = F.col("text")

    def measured(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        return let(repeated_words(ws), lambda r: let((n < 50) | (100 * r > 50 * n), lambda failed: F.struct(
            n.alias("n_words"), word_chars(ws).alias("word_chars"), symbols(text).alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"), r.alias("n_repeat_words"), failed.alias("base_failed"),
            (~F.when(failed, True).otherwise(cascade(rules, text, ws))).alias("kept"))))

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.select("doc_id", let(words(text), measured).alias("m")).select("doc_id", "m.*")


def keep(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns."""
    rules = ordered(estimate(sample_of(docs, sample_rows), [*BASE_RULES, *RULES]))
    text = text_of()
    return docs.where(~let(words(text), lambda ws: cascade(rules, text, ws)))


# DuckDB SQL of ``judged``
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT rid, list_filter(string_split_regex(text, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
p AS MATERIALIZED (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS MATERIALIZED (SELECT a.rid, a.i, a.word || ' ' || b.word || ' ' || c.word AS win
      FROM p a JOIN p b ON b.rid = a.rid AND b.i = a.i + 1 JOIN p c ON c.rid = a.rid AND c.i = a.i + 2),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls,
      len(string_split(text, chr(10))) AS n_lines FROM d),
m AS (SELECT d.doc_id, d.text, len(w.ws) AS n_words, length(array_to_string(w.ws, '')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_lines,
      coalesce(rep.n, 0) AS n_repeat_words,
      length(text) - length(replace(text, '!', '')) AS marks,
      length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS shouted,
      length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters
      FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > 0.3 * n_words OR marks > 0.3 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 16 * n_words
            OR letters < 0.5 * length(text) OR shouted > 0.5 * letters) AS kept
FROM b
"""
