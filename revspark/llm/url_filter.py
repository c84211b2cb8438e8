"""Operator 5 (native): URL rules, spread over redirect and canonical-link aliases.

A rule names a host suffix and a path prefix; the longest rule that fits an url
decides it. Urls without a rule take the method's verdict: pages are joined with
the urls that their own HTML declares to be the same (a canonical link or a
meta refresh), connected components of these links are the alias groups, and a
group passes its decisions on to members without a rule. An explicit allow comes
before a block: where a group holds both, its undecided members are allowed. Urls
without rule or decided alias are allowed.

Patterns hold no group that repeats, so urls and pages of any length are matched in a
constant stack. Nulls: a null or relative url has an empty host and path, fits no rule and is
allowed; null html declares nothing. Pages that repeat an url are judged alike.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import table
from revspark.llm.components import components

#: (verdict, host suffix, path prefix), the rules that the pages query is given.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def decided(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null.

    Length is that of the rule as written (host and path); of equal ones the
    greater in text order decides. A rule list is code-sized: it becomes one
    expression, so nothing is joined.
    """
    fits = [
        F.when(((host == suffix) | host.endswith(f".{suffix}")) & path.startswith(prefix),
               F.struct(F.lit(len(suffix) + len(prefix)).alias("size"),
                        F.lit(suffix + prefix).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, suffix, prefix in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in a tag's text, quoted or not."""
    found = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return F.trim(F.regexp_replace(found, r"^[\"']|[\"']$", ""))


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)(<{name}\b[^>]*>)"), F.lit(1))


def absolute(target: Column, page: Column) -> Column:
    """``target`` as an absolute url without fragment, as seen from the url ``page``."""
    scheme = F.regexp_extract(page, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(page, r"(?s)^.*?://([^/?#]*)", 1))
    folder = F.regexp_extract(path_of(page), r"(?s)^(.*/)", 1)
    out = (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
           .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
           .when(target.startswith("/"), F.concat(root, target))
           .when(target.startswith("?"), F.concat(root, path_of(page), target))
           .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target)))
    return F.regexp_replace(out, r"(?s)#.*$", "")


def node_of(url: Column) -> Column:
    """What two urls share if they name one resource: host, path and query."""
    query = F.regexp_extract(url, r"(?s)^[^#?]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), F.coalesce(query, F.lit("")))


def alias_links(pages: DataFrame) -> DataFrame:
    """(url, target) for each canonical link or meta refresh in a page's html."""
    found = pages.where(F.col("url").contains("://")
                        & F.col("html").rlike(r"(?i)canonical|http-equiv")).select("url", "html")
    links = F.transform(
        F.filter(_tags(F.col("html"), "link"),
                 lambda t: F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")),
        lambda t: _attribute(t, "href"))
    refreshes = F.transform(
        F.filter(_tags(F.col("html"), "meta"),
                 lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.regexp_replace(F.regexp_extract(
            _attribute(t, "content"), r"(?is)url\s*=\s*(.*)$", 1), r"^['\"\s]+|['\"\s]+$", ""))
    target = F.explode(F.concat(links, refreshes)).alias("target")
    return found.select("url", target).where("target <> ''").select(
        "url", absolute(F.col("target"), F.col("url")).alias("target"))


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    links = alias_links(pages).select(node_of(F.col("url")).alias("a"),
                                      node_of(F.col("target")).alias("b"))
    groups = components(links, "a", "b", "aliases")
    # a link's target counts with its own rule, whether or not it is a page here
    own = groups.withColumn("_d", decided(host_of(F.concat(F.lit("x://"), F.col("node"))),
                                          path_of(F.concat(F.lit("x://"), F.col("node"))), rules))
    # "allow" < "block": the smallest verdict of a group is an allow, if it has one
    passed = own.groupBy("component").agg(F.min("_d.verdict").alias("_group"))
    verdicts = groups.join(passed, "component").where("_group is not null").select("node", "_group")

    url = F.col("url")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                        node_of(url).alias("_node"))
    out = base.withColumn("_d", decided(F.col("host"), F.col("path"), rules))
    out = out.join(verdicts, out._node == verdicts.node, "left")
    return out.select("page_id", "host", "path", F.col("_d.rule").alias("rule"),
                      F.coalesce("_d.verdict", "_group", F.lit(default)).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    """DuckDB SQL of ``op5_url_filter``: the rules as a table, alias groups by a recursive query."""
    def host(u: str) -> str:
        return (f"coalesce(translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')")

    def path(u: str) -> str:
        return f"coalesce(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

    def node(u: str) -> str:
        return f"{host(u)} || {path(u)} || coalesce(regexp_extract({u}, '(?s)^[^#?]*(\\?[^#]*)', 1), '')"

    def attribute(name: str) -> str:
        value = f"""regexp_extract(tag, '(?is)\\b{name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>]+)', 1)"""
        return f"""trim(regexp_replace({value}, '^["'']|["'']$', '', 'g'))"""

    scheme = "regexp_extract(url, '(?s)^(.*?)://', 1)"
    root = f"{scheme} || '://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)"
    folder = f"coalesce(nullif(regexp_extract({path('url')}, '(?s)^(.*/)', 1), ''), '/')"
    rules = ", ".join(f"('{v}', '{s}', '{p}')" for v, s, p in RULES)
    return f"""
WITH RECURSIVE rules(verdict, suffix, prefix) AS (VALUES {rules}),
tags AS (
    SELECT url, 'link' AS kind, unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*>')) AS tag FROM pages WHERE contains(url, '://')
    UNION ALL
    SELECT url, 'meta', unnest(regexp_extract_all(html, '(?is)<meta\\b[^>]*>')) FROM pages WHERE contains(url, '://')
), targets AS (
    SELECT url, CASE WHEN kind = 'link' THEN {attribute('href')} ELSE regexp_replace(
        regexp_extract({attribute('content')}, '(?is)url\\s*=\\s*(.*)$', 1), '^[''"\\s]+|[''"\\s]+$', '', 'g') END AS target
    FROM tags
    WHERE CASE WHEN kind = 'link' THEN regexp_matches(lower({attribute('rel')}), '(^|\\s)canonical(\\s|$)')
               ELSE lower({attribute('http-equiv')}) = 'refresh' END
), whole AS (
    SELECT url, regexp_replace(CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
        WHEN starts_with(target, '//') THEN {scheme} || ':' || target
        WHEN starts_with(target, '/') THEN {root} || target
        WHEN starts_with(target, '?') THEN {root} || {path('url')} || target
        ELSE {root} || {folder} || target END, '(?s)#.*$', '') AS target
    FROM targets WHERE target <> ''
), links AS (
    SELECT {node('url')} AS a, {node('target')} AS b FROM whole
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT a, a FROM links UNION SELECT b, b FROM links),
reached(node, other) AS (
    SELECT a, b FROM edges UNION SELECT r.node, e.b FROM reached r JOIN edges e ON e.a = r.other
), places AS (
    SELECT DISTINCT 'x://' || other AS place, other FROM reached
), passed AS (
    SELECT r.node, min(best.verdict) AS verdict
    FROM reached r JOIN (
        SELECT other, max({{'size': length(suffix) + length(prefix), 'rule': suffix || prefix, 'verdict': verdict}}) AS best
        FROM places JOIN rules ON ({host('place')} = suffix OR ends_with({host('place')}, '.' || suffix))
                              AND starts_with({path('place')}, prefix)
        GROUP BY other) d ON d.other = r.other
    GROUP BY r.node
), judged AS (
    SELECT page_id, {host('url')} AS host, {path('url')} AS path, {node('url')} AS node, row_number() OVER () AS k FROM pages
), fits AS (
    SELECT k, max({{'size': length(suffix) + length(prefix), 'rule': suffix || prefix, 'verdict': rules.verdict}}) AS best
    FROM judged JOIN rules ON (host = suffix OR ends_with(host, '.' || suffix)) AND starts_with(path, prefix) GROUP BY k
)
SELECT page_id, host, path, fits.best.rule AS rule,
       coalesce(fits.best.verdict, passed.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM judged LEFT JOIN fits ON fits.k = judged.k LEFT JOIN passed ON passed.node = judged.node
"""


ORACLE_SQL = _oracle()
