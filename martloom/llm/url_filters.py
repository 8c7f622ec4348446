"""URL filters with redirect equivalence.

Pages that redirect to each other, or name the same canonical page, are one resource. Nodes
are urls in a canonical spelling, edges are redirects and canonical links; the connected
components are found by distributed star contraction, so no table of aliases ever sits in one
task. A block decision reaches all aliases of the blocked url, unless an alias is explicitly
allowed: within a component an allow rule takes precedence over block rules for the pages
that no rule fits. A page that a rule fits keeps that rule's decision.

Edges come from three places: a table of observed redirects, ``<meta http-equiv=refresh>``
and ``<link rel=canonical>`` of the pages, and spellings that name one resource by
definition (a fragment is never sent, host and scheme have no case, tracking parameters).

Defined cases: a null url, or one without ``://``, has empty host and path, no rule and no
alias, and is allowed; a null page gives no edges; repeated rows are judged alike; ties between rules of equal
length go to the block; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LOWER, UPPER, Scratch, lower_ascii, table
from martloom.llm.components import components


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for urls whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: The contract's rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

REFRESH = r"""(?is)<meta\b[^>]*http-equiv\s*=\s*["']?refresh\b[^>]*?\burl\s*=\s*['"]?([^'">\s]+)"""
CANONICAL = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'>\s]+)"""
)
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid)=[^&#]*"


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    host = lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0))
    return F.when(url.contains("://"), host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(url.contains("://"), path).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block"))
    found = None
    for rule in ordered:
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


#: scheme, host, path and query of an absolute url
PARTS = r"(?s)^([^:/?#]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical(url: Column) -> Column:
    """One spelling for urls that name one resource by definition; null without ``://``."""

    def part(n: int) -> Column:
        return F.regexp_extract(url, PARTS, n)

    host = F.regexp_replace(lower_ascii(part(2)), r":(?:80|443)$", "")
    query = F.concat(F.lit("?"), part(4))
    query = F.regexp_replace(query, rf"(?<=[?&]){TRACKING}(?:&|$)", "")
    query = F.regexp_replace(query, r"[?&]+$", "")
    path = F.regexp_replace(part(3), r"^$", "/")
    spelt = F.concat(lower_ascii(part(1)), F.lit("://"), host, path, query)
    return F.when(url.rlike(PARTS), spelt)


def absolute(link: Column, base: Column) -> Column:
    """``link`` as found on the page ``base``: absolute, or relative to scheme, host or folder."""
    scheme = F.substring_index(base, "://", 1)
    origin = F.regexp_extract(base, r"^[^:]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[^:]*://[^/?#]*(/(?:[^?#]*/)?)?", 0)
    folder = F.when(folder.endswith("/") & (folder != F.concat(scheme, F.lit("://"))), folder).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link != "", F.concat(folder, link))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): redirects and canonical links that the pages themselves declare."""
    links = F.array(F.regexp_extract("html", REFRESH, 1), F.regexp_extract("html", CANONICAL, 1))
    found = pages.select("url", F.explode(F.filter(links, lambda x: x != "")).alias("link"))
    target = canonical(absolute(F.regexp_replace("link", "&amp;", "&"), F.col("url")))
    return found.select(canonical(F.col("url")).alias("a"), target.alias("b"))


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) of every page.

    ``redirects`` has observed ones as (source, target) urls.
    """
    scratch = Scratch(pages.sparkSession, "url-filters")
    edges = page_edges(pages)
    if redirects is not None:
        seen = redirects.select(canonical(F.col("source")).alias("a"), canonical(F.col("target")).alias("b"))
        edges = edges.unionByName(seen)
    # Written first, so that the filter does not compute the spellings once more.
    edges = scratch.save(edges, "declared").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    groups = components(edges.distinct(), scratch)
    url = F.col("url")
    named = pages.select("page_id", canonical(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path"))
    named = named.withColumn("own", rule_of(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit("")), rules))
    # Rules count as the urls are spelt, on any page, and as the canonical spelling is, also that
    # of a redirect's end which is no page.
    of_node = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    spelt = named.where("node IS NOT NULL").select("node", F.explode(F.array("own.verdict", of_node)).alias("verdict"))
    ends = groups.select("node", of_node.alias("verdict"))
    given = spelt.unionByName(ends).where("verdict IS NOT NULL").distinct().join(groups, "node", "left")
    decided = given.groupBy(F.coalesce("component", "node").alias("component")).agg(
        F.max(F.col("verdict") == "allow").alias("allows"), F.max(F.col("verdict") == "block").alias("blocks")
    )
    inherited = F.when(F.col("allows"), "allow").when(F.col("blocks"), "block")
    decided = scratch.save(decided.select("component", inherited.alias("inherited")), "decided")
    # A url without an edge is a component of its own.
    alone = decided.join(groups.select(F.col("node").alias("component")), "component", "left_anti")
    alone = alone.select(F.col("component").alias("node"), "component", "inherited")
    groups = groups.join(decided, "component", "left").select("node", "component", "inherited")
    groups = scratch.save(groups.unionByName(alone), "groups")
    joined = named.join(groups, "node", "left")
    return joined.select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.col("own.name").alias("rule"),
        F.coalesce("own.verdict", "inherited", F.lit("allow")).alias("verdict"),
        F.coalesce("component", "node").alias("component"),
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_CASES = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(RULES, key=lambda r: -len(r.name))
)
_VERDICTS = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in RULES)

#: The tables hold no redirect or canonical link between urls; the propagation is tested apart.
ORACLE = {
    "op1_url_filters": f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r AS (SELECT *, CASE {_CASES} END AS rule FROM p)
SELECT page_id, host, path, rule, coalesce(CASE rule {_VERDICTS} END, 'allow') AS verdict FROM r
"""
}
