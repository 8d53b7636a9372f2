"""URL filters with redirect equivalence."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, session, table
from tallyloom.operators.components import component_roots
from tallyloom.session import stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Scheme, host, and path of an address, as far as the first `?` or `#`.
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z
    lower-cased; empty for null and for texts without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def address_of(url: Column) -> Column:
    """The resource a url names: host, path and query. Scheme and fragment make no difference, and
    an empty path is the root. Null for texts without a host."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)^[^?#]*(\?[^#]*)", 1)
    host = host_of(url)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(host != "", F.concat(host, path, query))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``name, verdict`` of the longest rule that fits, else null; of equally long ones an allowing
    rule comes first. The rules are part of the plan: their number is a parameter."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "allow", r.name))
    cases = [
        (
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")),
        )
        for r in order
    ]
    if not cases:
        return F.lit(None).cast("struct<name:string,verdict:string>")
    (fits, value), *others = cases
    return functools.reduce(lambda made, case: made.when(*case), others, F.when(fits, value))


def _attribute(tag: Column, name: str) -> Column:
    found = F.regexp_extract(tag, rf"(?is)[\s'\"]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>'\"]+)", 1)
    return F.regexp_replace(found, "^[\"']|[\"']$", "")


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``from_url, to_url``: the canonical links and the refresh redirects that pages declare.

    Only absolute targets, and those relative to the page's host or scheme, name another resource;
    other relative ones are resolved against the page's folder. ``&amp;`` in a target stands for
    ``&``.
    """
    source = F.col(url)
    tags = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    tag = pages.select(source.alias("from_url"), F.explode(tags).alias("tag"))
    rel = F.lower(_attribute(F.col("tag"), "rel"))
    refresh = F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh"
    target = F.when(
        F.lower(F.col("tag")).startswith("<link") & rel.rlike(r"(^|\s)canonical(\s|$)"),
        _attribute(F.col("tag"), "href"),
    ).when(
        F.lower(F.col("tag")).startswith("<meta") & refresh,
        F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)url\s*=\s*['\"]?([^'\"]+)", 1),
    )
    found = tag.select("from_url", F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))).alias("to"))
    scheme = F.regexp_extract("from_url", r"(?s)^(.*?://)", 1)
    origin = F.concat(scheme, host_of(F.col("from_url")))
    folder = F.regexp_extract(path_of(F.col("from_url")), r"(?s)^(.*/)", 1)
    whole = (
        F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(F.rtrim(scheme, F.lit("/")), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(origin, F.col("to")))
        .otherwise(
            F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("to"))
        )
    )
    return found.filter(F.col("to") != "").select("from_url", whole.alias("to_url"))


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """Input rows with ``host, path, rule, verdict`` and ``alias_root``.

    A rule that fits a page's own url decides it. For the rest, redirects (``from_url, to_url``),
    canonical links and refresh redirects join addresses to groups, of any length of chain; the
    root is the least address. A group with an allowed member is allowed, else one with a blocked
    member is blocked: an explicit allow comes before blocks that reach a page through aliases. The
    rules judge every address of a group, also targets that are no pages. All others are allowed.

    Null urls and texts without a host have no aliases and no rule, and are allowed. Pages that
    share an address share a group; repeated rows get equal verdicts. Columns of the input named
    like the added ones are replaced. Groups are found and joined as tables, one row per linked
    address, so a target that most pages point at is only a key like any other.
    """
    added = ("host", "path", "rule", "verdict", "alias_root")
    base = pages.drop(*added)
    links = page_links(pages, url, html) if html else None
    if redirects is not None:
        given = redirects.select("from_url", "to_url")
        links = given if links is None else links.unionByName(given)
    names = {n: free_name(base.columns, f"_{n}") for n in ("own", "address")}
    judged = (
        base.withColumn("host", host_of(F.col(url)))
        .withColumn("path", path_of(F.col(url)))
        .withColumn(names["own"], rule_of(F.col("host"), F.col("path"), rules))
        .withColumn(names["address"], address_of(F.col(url)))
    )
    own, address = F.col(names["own"]), F.col(names["address"])

    # The links between addresses, with the verdict of each end's rules.
    ends = None
    if links is not None:
        pairs = links.select(
            address_of(F.col("from_url")).alias("a"),
            address_of(F.col("to_url")).alias("b"),
            rule_of(host_of(F.col("from_url")), path_of(F.col("from_url")), rules)["verdict"].alias("va"),
            rule_of(host_of(F.col("to_url")), path_of(F.col("to_url")), rules)["verdict"].alias("vb"),
        ).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        pairs = stage(pairs.distinct(), "url-links")
        roots = component_roots(pairs.select("a", "b"))
        linked = pairs.select(F.col("a").alias("node"), F.col("va").alias("v")).unionByName(
            pairs.select(F.col("b").alias("node"), F.col("vb").alias("v"))
        )
        groups = (
            linked.filter("v is not null")
            .join(roots, "node")
            .groupBy("root")
            .agg(F.min("v").alias("group_verdict"))  # allow comes before block
        )
        ends = roots.join(groups, "root", "left").select(
            F.col("node").alias("_node"), F.col("root").alias("_root"), F.col("group_verdict").alias("_group")
        )
    if ends is None:
        group, root = F.lit(None).cast("string"), address
        joined = judged
    else:
        joined = judged.join(ends, address == ends["_node"], "left")
        group, root = ends["_group"], F.coalesce(ends["_root"], address)
    return joined.select(
        *[judged[c] for c in base.columns],
        judged["host"],
        judged["path"],
        own["name"].alias("rule"),
        F.coalesce(own["verdict"], group, F.lit("allow")).alias("verdict"),
        root.alias("alias_root"),
    )


def op5_urls(spark, sf_dir):
    """Every page judged by the rules, its aliases and their precedence."""
    pages = table(session(spark), sf_dir, "pages")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "alias_root")


# The same in SQL, with links written in quoted attributes and to absolute addresses.
OP5_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, coalesce(url, '') AS url, html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(host, path, verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM parts),
links AS (
  SELECT url, CASE
    WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)\srel\s*=\s*["'']?canonical')
      THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?refresh')
      THEN regexp_extract(tag, '(?is)url\s*=\s*([^"''\s>]+)', 1) END AS target
  FROM tags),
ends AS (
  SELECT url, url AS other, 0 AS side FROM links WHERE target LIKE '%://%'
  UNION ALL
  SELECT url, replace(target, '&amp;', '&'), 1 FROM links WHERE target LIKE '%://%'),
known AS (
  SELECT DISTINCT u AS url,
         translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         regexp_extract(u, '(?s)^[^?#]*(\?[^#]*)', 1) AS query
  FROM (SELECT url AS u FROM parts UNION SELECT other FROM ends)),
judged AS (
  SELECT k.url, k.host, k.path,
         CASE WHEN k.host <> '' THEN k.host || CASE WHEN k.path = '' THEN '/' ELSE k.path END || k.query END AS address,
         arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM known k LEFT JOIN rules r
    ON (k.host = r.host OR ends_with(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
  GROUP BY ALL),
edges AS (
  SELECT a.address AS a, b.address AS b FROM ends e JOIN judged a ON a.url = e.url
  JOIN judged b ON b.url = e.other WHERE e.side = 1 AND a.address IS NOT NULL AND b.address IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION
  SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
linked AS (
  SELECT r.node, min(r.other) AS root, min(j.verdict) AS verdict
  FROM reach r LEFT JOIN judged j ON j.address = r.other GROUP BY r.node)
SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.verdict, l.verdict, 'allow') AS verdict,
       coalesce(l.root, j.address) AS alias_root
FROM parts p JOIN judged j ON j.url = p.url LEFT JOIN linked l ON l.node = j.address
"""
