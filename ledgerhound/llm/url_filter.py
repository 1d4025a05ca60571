"""URL policy with redirect equivalence.

A rule is (action, host, path): it fits its host and all subdomains when the url's path starts with the rule's path; of the rules
that fit, the longest wins (then the one with the longer host, then allow). Pages also name aliases: a canonical link and a
refresh redirect each give an edge between the page's url and its target. Connected components over these edges are one
resource, and a block reaches every alias: a url that no rule fits is blocked if any url of its component is blocked by its
rule, else allowed. An explicit allow takes precedence: a url that an allow rule fits stays allowed, whatever its aliases.

All of it is DataFrame work. Urls meet the rules over their host suffixes, so the rule table can be of any size (Spark broadcasts it
only below its size threshold, and splits hot suffixes otherwise); edges and urls meet by url.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end. A null
url or one without ``://`` has empty host and path, fits no rule and has no alias. Null html gives no edge. Relative targets are
resolved against the page's scheme and host; a target's fragment is dropped, as are those of urls when they are compared as
aliases. Repeated pages give repeated rows; page_id can be null. Very long urls and pages need nothing special. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, table
from .components import components
from .registry import register

#: Fixed values of the query's rules: (action, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*http-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*'?([^"'\s>]+)"""


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]; an empty host has none."""
    labels = F.split(host, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules or [("allow", None, None)], "action string, rule_host string, rule_path string").filter("rule_host IS NOT NULL")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, action) of the distinct urls that a rule fits."""
    parts = urls.select("url").distinct().select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    met = (parts.select("url", "p", F.explode(suffixes(F.col("h"))).alias("suffix"))
           .join(rules, F.col("suffix") == F.col("rule_host")).filter(F.col("p").startswith(F.col("rule_path"))))
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("a"), F.length("rule_host").alias("b"), (F.col("action") == "allow").alias("c"),
                    rule.alias("rule"), F.col("action").alias("action"))
    return met.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.rule", "best.action")


def alias_key(url: Column) -> Column:
    """Urls are compared as aliases without their fragment and with their host in lower case."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.concat(lower_ascii(F.regexp_extract(url, r"(?s)\A(.*?://)", 1)), url_host(url), F.when(rest == "", F.lit("/")).otherwise(rest))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): alias keys of a page's url and of each canonical or redirect target that its html names."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = F.regexp_extract("url", r"(?s)\A(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract("url", r"(?s)\A(.*?:)//", 1)
    folder = F.regexp_extract("url", r"(?s)\A(.*?://[^/?#]*/(?:[^?#]*/)?)", 1)
    target = F.regexp_replace(F.col("target"), "&amp;", "&")
    full = (F.when(target.contains("://"), target).when(target.startswith("//"), F.concat(scheme, target))
            .when(target.startswith("/"), F.concat(base, target))
            .otherwise(F.concat(F.when(folder == "", F.concat(base, F.lit("/"))).otherwise(folder), target)))
    found = (pages.filter("url LIKE '%://%'")
             .withColumn("target", F.explode(F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(REFRESH), F.lit(1)))))
             .filter("target <> ''").withColumn("full", full))
    return found.select(alias_key(F.col("url")).alias("a"), alias_key(F.col("full")).alias("b"), F.col("full").alias("target_url"))


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, by_alias of every page. ``edges``: further (a, b, target_url) aliases, such as a crawl's redirects."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = alias_edges(pages)
    links = materialize(found if edges is None else found.unionByName(edges), "aliases")
    comp = components(links, "a", "b", "alias-components")
    urls = pages.select("url").unionByName(links.select(F.col("target_url").alias("url"))).filter("url LIKE '%://%'")
    own = materialize(ruled(urls, rules), "ruled")
    # Blocks spread over components; targets that are no page of the table bring their rule along, too.
    blocked = (own.filter("action = 'block'").select(alias_key(F.col("url")).alias("node")).distinct()
               .join(comp, "node").select(F.col("component").alias("bad")).distinct())
    spread = (comp.join(blocked, F.col("component") == F.col("bad"), "left_semi").select(F.col("node").alias("alias")))
    rows = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = (rows.join(own.withColumnRenamed("url", "own_url"), F.col("url") == F.col("own_url"), "left")
              .join(spread, alias_key(F.col("url")) == F.col("alias"), "left"))
    by_alias = F.col("rule").isNull() & F.col("alias").isNotNull()
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("action", F.when(by_alias, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                         by_alias.alias("by_alias"))


ORACLE = r"""
WITH rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
  FROM pages),
split AS (
  SELECT page_id, url, html, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fits AS (
  SELECT page_id, rules.h || rules.p AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rules.h || rules.p) DESC) AS nth
  FROM split JOIN rules ON (split.host = rules.h OR ends_with(split.host, '.' || rules.h)) AND starts_with(split.path, rules.p))
SELECT s.page_id, host, path, rule, coalesce(action, 'allow') AS verdict, false AS by_alias
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND nth = 1
"""


@register("op2_url_filter", ORACLE)
def op2_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))
