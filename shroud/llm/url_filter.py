"""URL filters by rules and redirect equivalence, in DataFrame functions only.

A URL's own verdict is that of the longest rule that fits its host and path. Redirects and canonical
links make URLs aliases of each other: pages' refresh and canonical tags, and a table of redirects if
there is one, are edges between URLs without scheme and fragment, and what edges connect is one
component. A page that no rule fits is blocked if its component holds a blocked URL and no URL that
a rule explicitly allows; else it is allowed.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import shared_dir, table
from shroud.llm.components import connected_components

#: (verdict, host, path) of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Rules of a list are tried row by row, without a join; a longer list is made a table.
MOST_RULES = 500
Rules = list[tuple[str, str, str]] | DataFrame

LINK, META = r"(?i)<link\b[^>]*>", r"(?i)<meta\b[^>]*>"
CANONICAL, REFRESH = r"(?i)\brel\s*=\s*[\"']?canonical\b", r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF, REFRESH_URL = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", r"(?i)\bcontent\s*=\s*[\"']?[^\"'>]*url\s*=\s*[\"']?([^\"'\s>]+)"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lowered), path, query with its ?; all empty for a null URL or one without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(verdict, rule) of the longest rule that fits, null if none does; of equally long ones an allow goes before a block, then the greater as text."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow", r[1] + r[2])):  # the last that fits stands
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def with_rules(rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows with ``found``, the best rule of their host and path.

    A table of rules (verdict, host, path), of any size, is joined on the host and its parent domains,
    for each host and path once; what is found is joined back. A list of over MOST_RULES is such a table.
    """
    if not isinstance(rules, DataFrame) and len(rules) > MOST_RULES:
        rules = rows.sparkSession.createDataFrame(rules, "verdict string, host string, path string").distinct()
    if not isinstance(rules, DataFrame):
        return rows.withColumn("found", best_rule(F.col("host"), F.col("path"), rules))
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    urls = rows.select("host", "path").where("host <> ''").distinct().select("host", "path", F.explode(parents).alias("rule_host"))
    table_ = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict", F.concat("host", "path").alias("rule"))
    fits = urls.join(table_, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.max_by(F.struct("verdict", "rule"), F.struct(F.length("rule"), F.col("verdict") == "allow", "rule")).alias("found")
    return rows.join(fits.groupBy("host", "path").agg(best), ["host", "path"], "left")


def node(url: Column) -> Column:
    """host/path?query of a URL; null without a host."""
    host, path, query = url_parts(url)
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def page_links(pages: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` from each page to the targets of its canonical links and refreshes; targets may be relative."""
    tagged = pages.where(F.col("html").rlike("(?i)canonical|http-equiv"))
    host, path, _ = url_parts(F.col("url"))

    def targets(tags: str, which: str, attribute: str) -> Column:
        fit = F.filter(F.regexp_extract_all("html", F.lit(tags), F.lit(0)), lambda t: t.rlike(which))
        return F.transform(fit, lambda t: F.regexp_extract(t, attribute, 1))

    found = F.filter(F.concat(targets(LINK, CANONICAL, HREF), targets(META, REFRESH, REFRESH_URL)), lambda t: t != "")
    rows = tagged.select("url", host.alias("host"), path.alias("path"), F.explode(found).alias("target"))
    target = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    whole = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(F.lit("http://"), "host", target))
        .otherwise(F.concat(F.lit("http://"), "host", F.regexp_replace("path", "[^/]*$", ""), target))
    )
    return rows.where("host <> ''").select(node(F.col("url")).alias("a"), node(whole).alias("b"))


def spread_blocks(edges: DataFrame, rules: Rules) -> DataFrame:
    """``alias`` of every URL that its component blocks: one there is blocked by a rule and none allowed by one."""
    found = connected_components(edges)
    host, path, _ = url_parts(F.concat(F.lit("x://"), "node"))
    judged = with_rules(found.select("node", "component", host.alias("host"), path.alias("path")), rules).select("component", F.col("found.verdict").alias("verdict"))
    bad = judged.groupBy("component").agg(F.count_if(F.col("verdict") == "block").alias("blocks"), F.count_if(F.col("verdict") == "allow").alias("allows")).where("blocks > 0 AND allows = 0")
    return found.join(bad, "component", "left_semi").select(F.col("node").alias("alias"))


def judge(pages: DataFrame, rules: Rules, folder: str, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    ``redirects`` may add edges between whole URLs (source, target). A null url or html, an empty
    one and one without :// have empty host and path, fit no rule, belong to no component, and are
    allowed. Very long pages are searched whole. Repeated rows and null ids come back as they are; other
    columns aren't read, so their names may clash; an empty table gives no rows. Edges and blocked aliases are written below ``folder``, so Spark knows their size when it picks the join.
    """
    spark = pages.sparkSession
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b")))
    edges.where("a IS NOT NULL AND b IS NOT NULL").distinct().write.parquet(f"{folder}/edges")
    edges = spark.read.schema("a string, b string").parquet(f"{folder}/edges")
    host, path, _ = url_parts(F.col("url"))
    rows = with_rules(pages.select("page_id", "url", host.alias("host"), path.alias("path")), rules)
    if edges.isEmpty():
        blocked = F.lit(False)
    else:
        spread_blocks(edges, rules).write.parquet(f"{folder}/blocked")
        aliases = spark.read.schema("alias string").parquet(f"{folder}/blocked")
        rows = rows.withColumn("node", node(F.col("url"))).join(aliases, F.col("node") == F.col("alias"), "left")
        blocked = F.col("alias").isNotNull()
    own = F.when(blocked, F.lit("block")).otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"))


def query() -> Callable:
    """The registered query over the whole table of pages."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return judge(table(spark, sf_dir, "pages"), RULES, shared_dir(spark, "url-filter"))

    return run


_UP, _LOW = string.ascii_uppercase, string.ascii_lowercase


def _sql_parts(url: str) -> str:
    rest = f"(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END)"
    return f"translate(regexp_extract({rest}, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host, regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract({rest}, '^[^?#]*(\\?[^#]*)', 1) AS query"


def _sql_rule(column: str) -> str:
    whens = []
    for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        value = verdict if column == "verdict" else host + path
        whens.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{value}'")
    return "CASE " + " ".join(whens) + " END"


def _sql_targets(tags: str, which: str, attribute: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return f"list_transform(list_filter(regexp_extract_all(html, {quote(tags)}), lambda t: regexp_matches(t, {quote(which)})), lambda t: regexp_extract(t, {quote(attribute)}, 1))"


SQL = f"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, {_sql_parts('url')} FROM pages
), nodes AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS node FROM parts
), targets AS (
  SELECT node, host AS own, regexp_replace(path, '[^/]*$', '') AS folder,
         replace(unnest({_sql_targets(LINK, CANONICAL, HREF)} || {_sql_targets(META, REFRESH, REFRESH_URL)}), '&amp;', '&') AS target
  FROM nodes WHERE host <> ''
), links AS (
  SELECT node, CASE WHEN contains(target, '://') THEN target WHEN starts_with(target, '//') THEN 'http:' || target
                    WHEN starts_with(target, '/') THEN 'http://' || own || target ELSE 'http://' || own || folder || target END AS url
  FROM targets WHERE target <> ''
), ends AS (
  SELECT node, {_sql_parts('url')} FROM links
), edges AS (
  SELECT DISTINCT node AS a, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS b FROM ends WHERE host <> ''
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), others AS (
  SELECT node, {_sql_parts("('x://' || other)")} FROM reach
), bad AS (
  SELECT node FROM (SELECT node, {_sql_rule('verdict')} AS v FROM others) GROUP BY node HAVING count_if(v = 'block') > 0 AND count_if(v = 'allow') = 0
)
SELECT page_id, host, path, {_sql_rule('rule')} AS rule,
       coalesce({_sql_rule('verdict')}, CASE WHEN node IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes
"""
