"""Queries that need DataFrame or SQL operations only: url rules, personal data."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.llm import pii, urlfilter
from dosewise.llm.common import read, register

# The contract's rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


def _duck_targets(word: str, tag: str, test: str, value: str) -> str:
    """DuckDB: the addresses that the fitting tags of a page declare."""
    tag, test, value, amp = (x.replace("'", "''") for x in (tag, test, value, urlfilter.AMPERSAND))
    return (f"CASE WHEN contains(lower(html), '{word}') THEN list_transform("
            f"list_filter(regexp_extract_all(html, '{tag}'), lambda x: regexp_matches(x, '{test}')), "
            f"lambda x: regexp_extract(regexp_replace(x, '{amp}', '&', 'g'), '{value}', 1)) ELSE [] END")


OP3_SQL = rf"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM cut
), keyed AS (
  SELECT *, CASE WHEN instr(url, '://') > 0
                 THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS addr
  FROM parts
), targets AS (
  SELECT url, host, path, addr, unnest(list_concat(
    {_duck_targets("canonical", urlfilter.LINK_TAG, urlfilter.IS_CANONICAL, urlfilter.HREF)},
    {_duck_targets("refresh", urlfilter.META_TAG, urlfilter.IS_REFRESH, urlfilter.REFRESH_URL)})) AS dest
  FROM keyed WHERE addr IS NOT NULL
), whole AS (
  SELECT addr, CASE
    WHEN instr(dest, '://') > 0 THEN substr(dest, instr(dest, '://') + 3)
    WHEN starts_with(dest, '//') THEN substr(dest, 3)
    WHEN starts_with(dest, '/') THEN host || dest
    ELSE host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || dest
    END AS rest
  FROM targets WHERE dest <> ''
), edges AS (
  SELECT addr AS a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END
         || regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS b
  FROM whole
), ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
nodes AS (
  SELECT DISTINCT a AS node, regexp_extract(a, '^[^/?#]*') AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM ways
), node_rule AS (
  SELECT node, arg_max(rv, (length(rh) + length(rp)) * 10000 + length(rh)) AS verdict
  FROM nodes JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY node
), reach(node) AS (
  SELECT node FROM node_rule WHERE verdict = 'block'
  UNION
  SELECT w.b FROM reach r JOIN ways w ON w.a = r.node
), fits AS (
  SELECT host, path, arg_max(rh || rp, (length(rh) + length(rp)) * 10000 + length(rh)) AS rule,
         arg_max(rv, (length(rh) + length(rp)) * 10000 + length(rh)) AS verdict
  FROM (SELECT DISTINCT host, path FROM keyed) JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path
)
SELECT k.page_id, k.host, k.path, f.rule,
       coalesce(f.verdict, CASE WHEN r.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM keyed k LEFT JOIN fits f ON f.host = k.host AND f.path = k.path
LEFT JOIN reach r ON r.node = k.addr
"""


@register("op3_url_redirect_rules", OP3_SQL)
def op3(spark, sf_dir):
    """Verdict of every page url by rule, else by its alias component."""
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS r(host, path, verdict)")
    return urlfilter.judge(read(spark, sf_dir, "pages"), rules)


def _duck_spans(kind: str, pattern: str, valid: str) -> str:
    """DuckDB: the located, validated and scored spans of one kind."""
    edge = "(?:^|[^a-z])"
    keep = "" if kind in pii.BASE else f" WHERE score >= {pii.KEEP}"
    return rf"""
  SELECT * FROM (
    SELECT rid, s AS start_at, {pii.KINDS.index(kind)} AS rank, e AS end_at, '{kind}' AS kind,
           {pii.SCORES[kind]} + CASE WHEN regexp_matches(lower(
             substr(t, greatest(s - {pii.NEAR}, 0) + 1, least(s, {pii.NEAR})) || ' ' || substr(t, e + 1, {pii.NEAR})),
             '{edge}({pii.CONTEXT[kind]})(?:[^a-z]|$)') THEN {pii.RAISE} ELSE 0 END AS score
    FROM (
      SELECT rid, t, x, (e - length(x))::BIGINT AS s, e::BIGINT AS e FROM (
        SELECT rid, t, x, sum(length(x) + length(piece)) OVER (PARTITION BY rid ORDER BY i) AS e
        FROM (SELECT rid, t, unnest(m) AS x, unnest(p[1:len(m)]) AS piece, unnest(range(len(m))) AS i
              FROM (SELECT rid, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM base))))
    WHERE {valid}){keep}"""


_EDGE_SQL = ("NOT regexp_matches(substr(t, s::BIGINT, CASE WHEN s > 0 THEN 1 ELSE 0 END), '[A-Za-z0-9]') "
             "AND NOT regexp_matches(substr(t, e::BIGINT + 1, 1), '[A-Za-z0-9]')")
_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
OP10_SQL = "WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), found AS (" + " UNION ALL ".join([
    _duck_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _duck_spans("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
                "len(list_filter(string_split(x, '.'), lambda q: coalesce(try_cast('0' || ltrim(q, '0') AS INTEGER) > 255, true))) = 0"),
    _duck_spans("card", r"[0-9](?:[\x20-]?[0-9])+",
                f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, 1 + length({_DIGITS})), "
                f"lambda i: CASE WHEN i % 2 = 1 THEN substr({_DIGITS}, length({_DIGITS}) - i + 1, 1)::INTEGER "
                f"ELSE substr({_DIGITS}, length({_DIGITS}) - i + 1, 1)::INTEGER * 2 "
                f"- CASE WHEN substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0"),
    _duck_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _duck_spans("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
                "length(replace(x, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform("
                "string_split(substr(replace(x, ' ', ''), 5) || substr(replace(x, ' ', ''), 1, 4), ''), "
                "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), "
                "lambda a, d: CASE WHEN d < 10 THEN (a * 10 + d) % 97 ELSE (a * 100 + d) % 97 END) = 1 AND " + _EDGE_SQL),
    _duck_spans("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _EDGE_SQL),
]) + r""")
SELECT b.doc_id,
       count(*) FILTER (f.kind = 'email') AS n_email, count(*) FILTER (f.kind = 'ip') AS n_ip,
       count(*) FILTER (f.kind = 'card') AS n_card, count(*) FILTER (f.kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(f.kind || ':' || f.start_at::BIGINT || ':' || f.end_at::BIGINT, ',' ORDER BY f.start_at, f.rank)
              FILTER (f.rank < 4), '')) AS base_sha256,
       coalesce(string_agg(f.kind || ':' || f.start_at::BIGINT || ':' || f.end_at::BIGINT, ',' ORDER BY f.start_at, f.rank)
              FILTER (f.kind IS NOT NULL), '') AS spans,
       coalesce(string_agg(f.score::VARCHAR, ',' ORDER BY f.start_at, f.rank) FILTER (f.kind IS NOT NULL), '') AS scores
FROM base b LEFT JOIN found f ON f.rid = b.rid
GROUP BY b.rid, b.doc_id
"""


@register("op10_pii_spans", OP10_SQL)
def op10(spark, sf_dir):
    """Personal data of every document: counts, digest and all spans."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs).select("doc_id", F.col("pii_spans").alias("found"))
    base = F.filter("found", lambda r: r["rank"] < len(pii.BASE))

    def count(kind):
        return F.size(F.filter("found", lambda r: r["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.BASE],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined("found").alias("spans"),
        F.array_join(F.transform("found", lambda r: r["score"].cast("string")), ",").alias("scores"))
