r"""URL filters with redirect equivalence.  DataFrame functions only.

A rule allows or blocks a host, all its subdomains, and the paths that start with its own; of
the rules that fit a URL the longest (host and path together) decides, of two that are as long
the one with the longer host.  Rules are joined on the suffixes of the host, so their number
has no bound.

A URL that no rule fits takes the decision of its aliases.  Redirects (``meta http-equiv=refresh``),
canonical links (``link rel=canonical``) and spellings of one address (scheme, default port,
fragment, tracking parameters) are edges between addresses; pages of one connected component
are aliases.  Targets that are no page of the table count too: rules are applied to every address
of a component, and an explicit allow takes precedence over a block.  A component without a
decision is allowed.

Rows.  The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; the path goes on to ``?``, ``#`` or the end.  A null URL, or one without ``://``,
has an empty host and path, fits no rule, has no alias and is allowed.  Null html has no
links.  Repeated URLs get one decision.  An empty table gives an empty result, no rules allow
everything.  Only the three columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import store
from feedlake.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "rule_host string, rule_path string, action string"

# Action, host and path of the rules in use.
PRODUCTION = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Query parameters that only track where a visitor came from.
TRACKING = r"(utm_[a-z]+|gclid|fbclid|ref)"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([(host, path, action) for action, host, path in rules], RULES)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """One spelling for a URL: no scheme, fragment, default port or tracking parameters; null without a host."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"(?i)^{TRACKING}(=|$)"))
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    rest = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, rest))


def targets(url: Column, html: Column) -> Column:
    """Absolute URLs that a page names as its canonical form or redirects to."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0)
    canonical = F.filter(tags, lambda t: t.rlike(r"""(?i)^<link\b[^>]*\brel\s*=\s*["']?canonical\b"""))
    refresh = F.filter(tags, lambda t: t.rlike(r"""(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b"""))
    found = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1)),
    )
    scheme, root = F.regexp_extract(url, r"^([A-Za-z][^:/?#]*:)//", 1), F.regexp_extract(url, r"^(.*?://[^/?#]*)", 1)
    absolute = F.transform(
        F.coalesce(found, F.array().cast("array<string>")),
        lambda t: F.when(t.contains("://"), t).when(t.startswith("//"), F.concat(scheme, t)).when(t.startswith("/"), F.concat(root, t)),
    )
    return F.filter(absolute, lambda t: t.isNotNull())


def edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pairs of addresses that redirects and canonical links join."""
    url = F.col(url_col)
    named = pages.select(address(url).alias("a"), F.explode(targets(url, F.col(html_col))).alias("target"))
    return named.select("a", address(F.col("target")).alias("b")).filter("a <> b").distinct()


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``action`` of the distinct places that a rule fits.

    The suffixes of a host are as many as its labels.  The best rule is a maximum, which
    combines before the shuffle.
    """
    places = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fits = places.withColumn("suffix", F.explode(suffix)).join(
        rules, (F.col("suffix") == F.col("rule_host")) & F.expr("startswith(path, rule_path)")
    )
    name = F.concat("rule_host", "rule_path")
    # Allow sorts before block: of one rule given both ways, the allow is taken.
    rank = F.struct(F.length(name).alias("n"), F.length("rule_host").alias("h"), (F.col("action") == "allow").alias("allow"), name.alias("rule"), "action")
    return fits.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the ``source`` of the verdict."""
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"),
        address(url).alias("address"),
    )
    links = store(edges(pages, url_col, html_col), "aliases")
    linked = components(links).toDF("address", "component")
    # Every address that a page has or names is judged, also one that no page was fetched from.
    named = rows.select("address").union(links.select("a")).union(links.select("b")).filter("address IS NOT NULL").distinct()
    host, path = F.regexp_extract("address", r"^([^/]*)", 1), F.regexp_extract("address", r"^[^/]*([^?]*)", 1)
    placed = named.join(linked, "address", "left").select(
        "address", host.alias("host"), path.alias("path"), F.coalesce("component", "address").alias("component")
    )
    matched = store(match(rows.select("host", "path").union(placed.select("host", "path")), rules), "rules")
    # Of the decisions of a component the allow comes first.
    explicit = placed.join(matched, ["host", "path"]).groupBy("component").agg(F.min("action").alias("inherited"))
    alias = store(placed.join(explicit.hint("rebalance"), "component").select("address", "inherited"), "verdicts")
    ruled = rows.join(matched.hint("rebalance"), ["host", "path"], "left")
    out = ruled.join(alias.hint("rebalance"), "address", "left")
    source = F.when(F.col("action").isNotNull(), "rule").when(F.col("inherited").isNotNull(), "alias").otherwise("default")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("action", "inherited", F.lit("allow")).alias("verdict"), source.alias("source")
    )
