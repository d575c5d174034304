"""URL filter by a path-template tree per host, on built-in functions only.

Paths become templates: runs of digits and long hexadecimal strings are
wildcards from the start.  The tree of a host is then grown level by level over
the different templates, not the pages.  Among the children of a node,

* a child is variable, and goes into the wildcard, if the node has more than
  ``max_children`` different children and the child has less than
  ``min_share`` of its pages.  A variable child of ``min_labels`` labels and
  more stays out if it differs by the z-test from the other variable children,
  or if these have no label; such children of like purity share one branch;
* labelled siblings merge if, ordered by their share of bad labels, neighbours
  do not differ by a two-proportion z-test.  So few children stay that the
  window over them is bounded.

A leaf's purity is its smoothed share of bad labels; with ``min_labels`` labels
and a purity of ``reject_at`` it rejects its pages.  It rejects the pages of a
child in a wildcard only if that child or several others there have labels in
the leaf.  Labels are the verdicts of
the rules where a rule fits, or a given column (true: bad, null: none).

Segments behind the ``max_depth``-th are one variable tail.  A url that is null
or has no ``://`` has empty host and path, which are judged like any other.
Repeated rows are judged alike.  Further columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

MAX_DEPTH = 8
MAX_CHILDREN = 20
MIN_SHARE = 0.05
Z = 1.96
SMOOTHING = 5.0
MIN_LABELS = 5
REJECT_AT = 0.8


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path begins with ``path``."""

    block: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


#: The rules of the registered query (fixed values).
RULES = [Rule(True, "net", "/"), Rule(False, "example.net", "/en/"), Rule(True, "example.com", "/de/"),
         Rule(False, "org", "/fr/")]


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url")))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` and ``ruled_block`` of the longest rule that fits, null where none does."""
    rule, block = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        rule, block = F.when(r.fits, r.text).otherwise(rule), F.when(r.fits, r.block).otherwise(block)
    return pages.withColumns({"rule": rule, "ruled_block": block})


def template(path: Column, max_depth: int = MAX_DEPTH) -> Column:
    """The segments of a path, digits and long hexadecimal strings generalised."""
    plain = F.regexp_replace(path, r"[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}|(?<![0-9a-zA-Z])[0-9a-f]{16,}(?![0-9a-zA-Z])", "*")
    segments = F.split(F.regexp_replace(F.regexp_replace(plain, r"[0-9]+", "*"), r"^/", ""), "/", -1)
    return F.when(F.size(segments) > max_depth,
                  F.concat(F.slice(segments, 1, max_depth - 1), F.array(F.lit("**")))).otherwise(segments)


def tree(pages: DataFrame, max_depth: int = MAX_DEPTH, max_children: int = MAX_CHILDREN,
         min_share: float = MIN_SHARE, min_labels: int = MIN_LABELS) -> DataFrame:
    """``host, segments, node`` for every template of ``pages`` (``host, segments, bad``), with the node's label counts.

    ``backed`` is false where a template is in a wildcard and the node's labels
    are those of one other child there.
    """
    now = cut(pages.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labels"), F.count_if("bad").alias("bads"))
        .withColumns({"node": F.lit(""), "pooled": F.array().cast("array<boolean>")}))
    depth = now.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(depth, max_depth)):
        deep = now.where(F.size("segments") > level).withColumn("seg", F.get("segments", F.lit(level)))
        children = deep.groupBy("host", "node", "seg").agg(*[F.sum(c).alias(c) for c in ("n", "labels", "bads")])
        parents = children.groupBy("host", "node").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("all"))
        variable = (F.col("different") > max_children) & (F.col("n") < min_share * F.col("all"))
        named = _named(children.join(parents, ["host", "node"]).withColumn("variable", variable), min_labels)
        # a segment never holds a digit, so the name of a purity is none
        shown = F.when(F.bool_and("kept") & (F.count(F.lit(1)) == 1), F.min("seg")).otherwise(F.col("name"))
        merged = _merged(named.groupBy("host", "node", "name").agg(
            F.sum("labels").alias("labels"), F.sum("bads").alias("bads"), shown.alias("shown")))
        to = (named.select("host", "node", "seg", "name", "variable").join(merged, ["host", "node", "name"])
              .select("host", "node", "seg", "variable", F.concat_ws("/", "node", "branch").alias("to")))
        now = cut(deep.join(to, ["host", "node", "seg"]).withColumn("pooled", F.array_append("pooled", F.col("variable")))
                  .drop("node", "seg", "variable").withColumnRenamed("to", "node")
                  .unionByName(now.where(F.size("segments") <= level)))
    levels = range(min(depth, max_depth))
    pooled = [F.coalesce(F.get("pooled", F.lit(i)), F.lit(False)) for i in levels]
    segs = [F.when(p & (F.col("labels") > 0), F.get("segments", F.lit(i))) for i, p in zip(levels, pooled)]
    stats = now.groupBy("host", "node").agg(
        F.sum("labels").alias("labels"), F.sum("bads").alias("bads"),
        F.array(*[F.min(x) for x in segs]).alias("low"), F.array(*[F.max(x) for x in segs]).alias("high"))
    backed = F.lit(True)
    for i, p in zip(levels, pooled):
        low, high = F.get("low", F.lit(i)), F.get("high", F.lit(i))
        backed &= ~p | F.coalesce((low != high) | (low == F.get("segments", F.lit(i))), F.lit(False))
    return (now.select("host", "segments", "node", "pooled").join(stats, ["host", "node"])
            .select("host", "segments", "node", "labels", "bads", backed.alias("backed")))


def _differ(bads: Column, labels: Column, bads0: Column, labels0: Column) -> Column:
    """The two-proportion z-test."""
    p = (bads + bads0) / (labels + labels0)
    spread = F.sqrt(p * (1 - p) * (1 / labels + 1 / labels0))
    return F.abs(bads / labels - bads0 / labels0) > Z * spread


def _named(children: DataFrame, min_labels: int) -> DataFrame:
    """Adds ``name``, and ``kept`` where a variable child differs from the others and is named by its purity in tenths."""
    pool = children.where("variable").groupBy("host", "node").agg(
        F.sum("labels").alias("pool_labels"), F.sum("bads").alias("pool_bads"))
    rest, rest_bads = F.nullif(F.col("pool_labels") - F.col("labels"), F.lit(0)), F.col("pool_bads") - F.col("bads")
    stands_out = F.coalesce(_differ(F.col("bads"), F.nullif("labels", F.lit(0)), rest_bads, rest), rest.isNull())
    tenth = F.concat(F.lit("*"), F.format_number(F.floor(10 * F.col("bads") / F.nullif("labels", F.lit(0))) / 10, 1))
    kept = F.col("variable") & (F.col("labels") >= min_labels) & stands_out
    return (children.join(pool, ["host", "node"], "left").withColumn("kept", kept)
            .withColumn("variable", F.col("variable") & ~F.col("kept"))
            .withColumn("name", F.when(F.col("kept"), tenth).when(F.col("variable"), "*").otherwise(F.col("seg")))
            .drop("pool_labels", "pool_bads"))


def _merged(children: DataFrame) -> DataFrame:
    """``host, node, name, branch``: labelled siblings with like shares of bad labels get one branch."""
    order = Window.partitionBy("host", "node").orderBy(F.col("bads") / F.col("labels"), "name")
    labelled = children.where("labels > 0").withColumns({
        "n0": F.lag("labels").over(order), "b0": F.lag("bads").over(order)})
    differ = _differ(F.col("bads"), F.col("labels"), F.col("b0"), F.col("n0"))
    group = labelled.withColumn("group", F.sum(F.when(differ, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # siblings are few: at most max_children, the 1 / min_share with a share of their own, one per tenth, and the wildcard
    names = group.groupBy("host", "node", "group").agg(
        F.array_join(F.array_sort(F.collect_list("shown")), "|").alias("branch"))
    return (group.join(names, ["host", "node", "group"]).select("host", "node", "name", "branch")
            .unionByName(children.where("labels = 0").select("host", "node", "name", F.col("name").alias("branch"))))


def judged(pages: DataFrame, rules: list[Rule] | None = None, bad: str | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every page.

    ``bad`` names a boolean column of ``pages`` to learn from; without it the
    rules' verdicts are the labels.
    """
    rules = RULES if rules is None else rules
    if bad is None:
        rows = ruled(parsed(pages), rules).withColumn("bad", F.col("ruled_block"))
    else:
        given = pages.select("page_id", "url", F.col(bad).cast("boolean").alias("bad"))
        rows = ruled(parsed(given.select(F.struct("page_id", "bad").alias("page_id"), "url")), rules).select(
            "page_id.page_id", "host", "path", "rule", "ruled_block", "page_id.bad")
    rows = rows.withColumn("segments", template(F.col("path")))
    leaves = tree(rows.select("host", "segments", "bad"))
    overall = leaves.select("host", "node", "labels", "bads").distinct().agg(
        (F.coalesce(F.sum("bads") / F.nullif(F.sum("labels"), F.lit(0)), F.lit(0.0))).alias("prior")).first()[0]
    purity = (F.col("bads") + SMOOTHING * overall) / (F.col("labels") + SMOOTHING)
    rejects = (F.col("labels") >= MIN_LABELS) & (purity >= REJECT_AT) & F.col("backed")
    verdicts = leaves.select("host", "segments", F.concat("host", "node").alias("template"), purity.alias("purity"),
                             rejects.alias("rejects"))
    return rows.join(verdicts, ["host", "segments"]).select(
        "page_id", "host", "path", "rule",
        F.when(F.coalesce("ruled_block", "rejects"), "block").otherwise("allow").alias("verdict"), "template", "purity")


# DuckDB SQL of ``judged`` with its defaults; hexadecimal runs are replaced twice, as neighbours share a separator
_HEX_RUN = "(^|[^0-9a-zA-Z])[0-9a-f]{16,}($|[^0-9a-zA-Z])"


def _level_sql(level: int) -> str:
    """The tables that turn ``t{level}`` into ``t{level + 1}``."""
    k = level
    return f"""
deep{k} AS MATERIALIZED (SELECT *, segments[{k + 1}] AS seg FROM t{k} WHERE len(segments) > {k}),
c{k} AS (SELECT host, node, seg, sum(n)::BIGINT AS n, sum(labels)::BIGINT AS labels, sum(bads)::BIGINT AS bads
  FROM deep{k} GROUP BY host, node, seg),
named{k} AS MATERIALIZED (SELECT *, CASE WHEN count(*) OVER p > {MAX_CHILDREN} AND n < {MIN_SHARE}::DOUBLE * sum(n) OVER p
  THEN '*' ELSE seg END AS name FROM c{k} WINDOW p AS (PARTITION BY host, node)),
sib{k} AS MATERIALIZED (SELECT host, node, name, sum(labels)::BIGINT AS labels, sum(bads)::BIGINT AS bads
  FROM named{k} GROUP BY host, node, name),
lag{k} AS (SELECT *, lag(labels) OVER o AS n0, lag(bads) OVER o AS b0 FROM sib{k} WHERE labels > 0
  WINDOW o AS (PARTITION BY host, node ORDER BY bads / labels, name)),
dif{k} AS (SELECT *, abs(bads / labels - b0 / n0) > {Z}::DOUBLE * sqrt((bads + b0) / (labels + n0)
  * (1 - (bads + b0) / (labels + n0)) * (1 / labels + 1 / n0)) AS differ FROM lag{k}),
grp{k} AS (SELECT *, sum(CASE WHEN differ THEN 1 ELSE 0 END) OVER (
  PARTITION BY host, node ORDER BY bads / labels, name ROWS UNBOUNDED PRECEDING) AS g FROM dif{k}),
br{k} AS (SELECT host, node, name, array_to_string(list_sort(list(name) OVER (PARTITION BY host, node, g)), '|') AS branch
  FROM grp{k} UNION ALL SELECT host, node, name, name FROM sib{k} WHERE labels = 0),
t{k + 1} AS MATERIALIZED (SELECT d.host, d.segments, d.n, d.labels, d.bads, concat_ws('/', d.node, b.branch) AS node
  FROM deep{k} d JOIN named{k} m USING (host, node, seg) JOIN br{k} b ON b.host = d.host AND b.node = d.node AND b.name = m.name
  UNION ALL SELECT host, segments, n, labels, bads, node FROM t{k} WHERE len(segments) <= {k}),"""


def _fit_sql(rule: Rule) -> str:
    return f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"


def _rules_sql(value) -> str:
    longest_first = sorted(RULES, key=lambda r: (len(r.text), r.text), reverse=True)
    return "CASE " + " ".join(f"WHEN {_fit_sql(r)} THEN {value(r)}" for r in longest_first) + " END"


ORACLE = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
ruled AS (SELECT *, {_rules_sql(lambda r: f"'{r.text}'")} AS rule, {_rules_sql(lambda r: r.block)} AS bad,
  string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(path,
    '[0-9a-fA-F]{{8}}-[0-9a-fA-F-]{{27}}', '*', 'g'), '{_HEX_RUN}', '\\1*\\2', 'g'), '{_HEX_RUN}', '\\1*\\2', 'g'),
    '[0-9]+', '*', 'g'), '^/', ''), '/') AS whole FROM parts),
rows AS MATERIALIZED (SELECT page_id, host, path, rule, bad, CASE WHEN len(whole) > {MAX_DEPTH}
  THEN list_append(whole[1:{MAX_DEPTH - 1}], '**') ELSE whole END AS segments FROM ruled),
t0 AS MATERIALIZED (SELECT host, segments, count(*) AS n, count(bad) AS labels, count(*) FILTER (WHERE bad) AS bads, '' AS node
  FROM rows GROUP BY host, segments),{"".join(_level_sql(k) for k in range(MAX_DEPTH))}
leaf AS (SELECT host, node, sum(labels)::BIGINT AS labels, sum(bads)::BIGINT AS bads FROM t{MAX_DEPTH} GROUP BY host, node),
prior AS (SELECT coalesce(sum(bads)::BIGINT / nullif(sum(labels)::BIGINT, 0), 0)::DOUBLE AS q FROM leaf),
verdicts AS (SELECT t.host, t.segments, t.host || t.node AS template, l.labels,
  (l.bads + {SMOOTHING}::DOUBLE * q) / (l.labels + {SMOOTHING}::DOUBLE) AS purity
  FROM t{MAX_DEPTH} t JOIN leaf l USING (host, node), prior)
SELECT page_id, rows.host, path, rule, CASE WHEN coalesce(bad, labels >= {MIN_LABELS} AND purity >= {REJECT_AT}::DOUBLE)
  THEN 'block' ELSE 'allow' END AS verdict, template, purity
FROM rows JOIN verdicts v ON v.host = rows.host AND v.segments = rows.segments
"""
