"""URL verdicts by rules, and by redirect equivalence where no rule fits.

Pages that declare a canonical link or a redirect are aliases of its target.
Components of that graph share block decisions: a page without a rule of its
own is blocked if any URL of its component is blocked by a rule. A page's own
rule always decides for itself, so an explicit allow takes precedence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm.common import ascii_lower, text_or_empty
from lapwise.llm.components import connected_components

# (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Rules up to this number are broadcast.
BROADCAST_RULES = 100_000


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def url_key(url: Column) -> Column:
    """What names a resource: host, path and query, without scheme and fragment."""
    return F.concat(host_of(url), F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1))


def declared_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(a, b): the key of a page's URL and those of its canonical link and of its refresh redirect.

    Relative targets are resolved against the page's URL. Each step is its own
    projection, so that no expression is spelt out many times.
    """
    quoted = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def attribute(tag: str, name: str) -> Column:
        return F.concat(*[F.regexp_extract(tag, rf"(?is)\b{name}{quoted}", i) for i in (1, 2, 3)])

    html = text_or_empty(html_col)
    # A cheap test first: few pages declare anything.
    rows = pages.filter(html.rlike("(?i)canonical|http-equiv")).select(text_or_empty(url_col).alias("url"), html.alias("html"))
    rows = rows.select(
        "url",
        F.regexp_extract("html", r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*>""", 0).alias("link"),
        F.regexp_extract("html", r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>""", 0).alias("meta"),
    )
    rows = rows.select("url", F.trim(attribute("link", "href")).alias("link"), attribute("meta", "content").alias("meta"))
    refresh = F.trim(F.regexp_extract("meta", r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1))
    rows = rows.select("url", F.explode(F.array(F.col("link"), refresh)).alias("to")).filter("to != ''")
    rows = rows.select(
        F.replace("to", F.lit("&amp;"), F.lit("&")).alias("to"),
        url_key(F.col("url")).alias("a"),
        host_of(F.col("url")).alias("host"),
        F.regexp_extract(path_of(F.col("url")), r"^.*/", 0).alias("folder"),
    )
    folder = F.when(F.col("folder") == "", "/").otherwise(F.col("folder"))
    target = (
        F.when(F.locate("://", F.col("to")) > 0, F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), "to"))
        .when(F.startswith("to", F.lit("/")), F.concat(F.lit("x://"), "host", "to"))
        .otherwise(F.concat(F.lit("x://"), "host", folder, "to"))
    )
    return rows.select("a", target.alias("to")).select("a", url_key(F.col("to")).alias("b"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "own string, r_host string, r_path string")


def with_rule(rows: DataFrame, keys: Sequence[str], rules: DataFrame) -> DataFrame:
    """`keys`, rule and own (verdict) of the rows (keys, host, path) that a rule fits: the longest one.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Rows meet rules by the suffixes of their host.
    """
    known = rules.count()
    rules = rules.withColumn("rule", F.concat("r_host", "r_path"))
    rules = F.broadcast(rules) if known <= BROADCAST_RULES else rules
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    spread = rows.filter(F.col("host") != "").select(*keys, "path", F.explode(suffixes).alias("suffix"))
    fits = (F.col("suffix") == F.col("r_host")) & F.startswith("path", "r_path")
    best = F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("own"))).alias("best")
    return spread.join(rules, fits).groupBy(*keys).agg(best).select(*keys, "best.rule", "best.own")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] | DataFrame = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    `redirects` (src, dst: URLs) adds edges to those that pages declare. A
    null URL or one without `://` has an empty host and path, fits no rule and
    is allowed. Nulls in the html declare nothing. Repeated rows are judged
    alike; an empty table gives no rows.
    """
    spark = pages.sparkSession
    rules = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    url = text_or_empty(url_col)
    judged = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), url_key(url).alias("key"))
    edges = declared_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(url_key(F.col("src")).alias("a"), url_key(F.col("dst")).alias("b")))
    aliases = connected_components(edges.filter((F.col("a") != "") & (F.col("b") != "")))

    # Pages share few host and path pairs less than rows; rules are found once for each pair.
    found = with_rule(judged.select("host", "path").distinct(), ["host", "path"], rules)
    found = found.withColumnsRenamed({"host": "f_host", "path": "f_path"})
    same = (judged["host"] == found["f_host"]) & (judged["path"] == found["f_path"])
    judged = judged.join(found, same, "left").drop("f_host", "f_path")
    method = F.lit("allow")
    if aliases is not None:
        named = aliases.withColumn("host", F.regexp_extract("node", r"^[^/?#]*", 0))
        named = named.withColumn("path", F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1))
        blocked = with_rule(named, ["node", "component"], rules).filter("own = 'block'").select("component").distinct()
        blocked = aliases.join(blocked, "component", "left_semi").select(F.col("node").alias("b_node"))
        judged = judged.join(blocked, judged["key"] == blocked["b_node"], "left")
        method = F.when(F.col("b_node").isNotNull(), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("own", method).alias("verdict")
    )


SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM u),
r(own, r_host, r_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
e AS (
  SELECT host || tail AS a, regexp_replace(regexp_replace(regexp_extract(
           regexp_extract(html, '(?is)<link\b[^>]*rel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]*)', 1),
           '^[^:]*://', ''), '#.*$', '') AS b FROM p WHERE contains(lower(html), 'canonical')),
n AS (SELECT a, b FROM e WHERE b <> '' UNION SELECT b, a FROM e WHERE b <> ''),
c(a, b) AS (SELECT a, b FROM n UNION SELECT c.a, n.b FROM c JOIN n ON c.b = n.a),
m AS (
  SELECT p.page_id, p.host, p.path, p.tail, arg_max(r.r_host || r.r_path, length(r.r_host || r.r_path)) AS rule,
         arg_max(r.own, length(r.r_host || r.r_path)) AS own
  FROM p LEFT JOIN r ON (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path)
  GROUP BY ALL),
bad AS (SELECT DISTINCT c.a AS node FROM c JOIN m ON m.host || m.tail = c.b WHERE m.own = 'block')
SELECT page_id, host, path, rule,
       coalesce(own, CASE WHEN host || tail IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM m
"""
