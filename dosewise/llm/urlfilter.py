"""URL rules with redirect equivalence, in DataFrame operations only.

A rule (host, path, verdict) fits its host and all subdomains when the url's
path starts with the rule's path; the longest host + path wins (then the longer
host, then allow before block).  Pages that declare another address of
themselves (a canonical link or a meta refresh redirect) are joined with it;
connected components of those edges are aliases of one resource.  A component
with a blocked address blocks its members that no rule judges; an address that
an explicit rule allows stays allowed.

Scale: the rules are matched once per distinct host; the host's few rules are
then looked up by the pages.  Only pages that declare an alias enter the edge
table, so without aliases no component work runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.llm.components import components
from dosewise.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK_TAG, META_TAG = r"(?i)<link\b[^>]*>", r"(?i)<meta\b[^>]*>"
# canonical as one of the words of rel, quoted or not
IS_CANONICAL = (r"(?i)\brel\s*=\s*(?:\x22(?:[^\x22]*\s)?canonical[\s\x22]|'(?:[^']*\s)?canonical[\s']|canonical\b)")
IS_REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\x22']?refresh\b"
HREF = r"(?i)\bhref\s*=\s*[\x22']?([^\x22'\s>]+)"
AMPERSAND = r"&(?:amp;|AMP;|#0*38;|#[xX]0*26;)"
REFRESH_URL = r"(?i)\burl\s*=\s*[\x22']?([^\x22'\s>;]+)"


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(rest(url), "^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """The key of a resource: host, path (``/`` if empty) and query, without
    scheme and fragment; null for a url without ``://``."""
    p = path(url)
    return F.when(F.instr(url, "://") > 0, F.concat(
        host(url), F.when(p == "", "/").otherwise(p), F.regexp_extract(rest(url), r"^[^?#]*(\?[^#]*)", 1)))


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` (null if none fits) to rows with
    columns ``host`` and ``path``."""
    # a rule's host has few labels, so only that many suffixes of a host are tried
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(most, 1)))),
                        lambda k: F.array_join(F.slice(labels, -k, k), "."))
    r = rules.select(F.col("host").alias("tail"), F.struct(
        (F.length("host") + F.length("path")).alias("long"), F.length("host").alias("host_long"),
        (F.col("verdict") == "allow").alias("allows"), "path", "verdict",
        F.concat("host", "path").alias("rule")).alias("r"))
    known = (urls.select("host").distinct().select("host", F.explode(tails).alias("tail"))
             .join(r, "tail").groupBy("host").agg(F.collect_list("r").alias("_rules")))
    # written, so that the planner knows its size (one row per host that a rule
    # fits) and, where it is large, can split a host with very many pages
    known = stored(known, "host-rules")
    best = F.array_max(F.filter("_rules", lambda x: F.startswith(F.col("path"), x["path"])))
    return (urls.join(known, "host", "left").withColumn("_best", best)
            .withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict"))
            .drop("_rules", "_best"))


def aliases(pages: DataFrame) -> DataFrame:
    """(a, b): a page's address and each one that it declares as its own."""
    html, low = F.coalesce("html", F.lit("")), F.lower(F.coalesce("html", F.lit("")))

    def targets(word, tag, test, value):
        tags = F.filter(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda x: F.rlike(x, F.lit(test)))
        # decoded first: the ; of an &amp; would end a refresh address
        return F.when(F.instr(low, word) > 0, F.transform(
            tags, lambda x: F.regexp_extract(F.regexp_replace(x, AMPERSAND, "&"), value, 1))).otherwise(F.array().cast("array<string>"))

    found = pages.where(F.instr(F.col("url"), "://") > 0).where(
        (F.instr(low, "canonical") > 0) | (F.instr(low, "refresh") > 0)).select(
        "url", F.explode(F.array_union(targets("canonical", LINK_TAG, IS_CANONICAL, HREF),
                                       targets("refresh", META_TAG, IS_REFRESH, REFRESH_URL))).alias("to"))
    u, to = F.col("url"), F.col("to")
    base = F.concat(F.substring_index(u, "://", 1), F.lit("://"), host(u))
    folder = F.regexp_extract(path(u), "^(.*/)", 1)
    whole = (F.when(F.instr(to, "://") > 0, to)
             .when(F.startswith(to, F.lit("//")), F.concat(F.lit("http:"), to))
             .when(F.startswith(to, F.lit("/")), F.concat(base, to))
             .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), to)))
    return found.where("to <> ''").select(address(u).alias("a"), address(whole).alias("b"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html), ``rules`` (host, path, verdict) ->
    (page_id, host, path, rule, verdict), one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path and is
    allowed unless a rule says otherwise.  Null html declares no alias.
    Repeated rows are kept; other columns are not carried.
    """
    roots = components(aliases(pages))
    nodes = roots.select("node", "root", host(F.concat(F.lit("http://"), "node")).alias("host"),
                         path(F.concat(F.lit("http://"), "node")).alias("path"))
    bad = (judged(nodes, rules).where("rule_verdict = 'block'").select("root").distinct()
           .join(roots, "root").select(F.col("node").alias("_address"), F.lit("block").alias("_spread")))
    own = pages.select("page_id", address(F.col("url")).alias("_address"),
                       F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
                       F.coalesce(path(F.col("url")), F.lit("")).alias("path"))
    return (judged(own, rules).join(bad, "_address", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", "_spread", F.lit("allow")).alias("verdict")))
