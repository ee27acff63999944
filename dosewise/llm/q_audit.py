"""Queries of the audits: periodic runs, filter interaction, licences."""

from __future__ import annotations

import zlib
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from dosewise.llm import interaction, licences, periodic
from dosewise.llm.common import read, register


def looped(doc_id: str, n: int) -> np.ndarray | None:
    """The contract's order of words: documents whose crc32 ends in 0 repeat a
    part of their words from one place on."""
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    """Periodic runs of every document: number, the longest, digests of all runs
    and of the text without repeats."""
    found = periodic.find(read(spark, sf_dir, "documents"), least=6, factor=4, order=looped)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
                       F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))

OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), l AS (
  SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS bad
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), cells AS (
  SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, bad
), orders(o) AS (VALUES {_ORDERS}), steps AS (
  SELECT o, unnest(range(1, 6)) AS step FROM orders
), stepped AS (
  SELECT o, step, list_transform(range(1, 6), lambda k: ascii(substr(o, k, 1)) - 64) AS axes FROM steps
), sums AS (
  SELECT part, o, step, axes[step] AS own,
    coalesce(sum(n) FILTER (len(list_filter(axes[1:step], lambda a: bad[a])) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (bad[axes[step]] AND len(list_filter(axes[1:step - 1], lambda a: bad[a])) = 0), 0) AS removed,
    coalesce(sum(n) FILTER (bad[axes[step]] AND len(list_filter(axes[1:step - 1], lambda a: bad[a])) > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (bad[axes[step]] AND len(list_filter(bad, lambda b: b)) = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (bad[axes[step]] AND len(list_filter(axes[1:step - 1], lambda a: bad[a])) = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (bad[axes[step]] AND len(list_filter(axes[1:step - 1], lambda a: bad[a])) = 0), 0) AS toxic_lost
  FROM cells CROSS JOIN stepped GROUP BY part, o, step, axes
)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM sums
"""


@register("op12_filter_interaction", OP12_SQL)
def op12(spark, sf_dir):
    """What each of five filters removes at each step of each order, per source."""
    return interaction.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "source")


def _rule_rows(rules) -> str:
    return ", ".join(f"({k}, '{label}', '{keyword}', '{pattern}', {weight}::DOUBLE)"
                     for k, (label, keyword, pattern, weight) in enumerate(rules))


_BASE_ROWS = ", ".join(f"('{label}', ' {phrase.replace(' ', '  ')} ')" for phrase, label in licences.BASE)

OP13_SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, trim(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS t FROM documents
), d AS (
  SELECT rid, doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS n_words,
         ' ' || replace(t, ' ', '  ') || ' ' AS s FROM w
), rules(rank, label, keyword, pattern, weight) AS (VALUES {_rule_rows(licences.RULES)}),
phrases(label, phrase) AS (VALUES {_BASE_ROWS}),
cut AS (
  SELECT rid, rank, label, weight, regexp_extract_all(s, pattern) AS m, string_split_regex(s, pattern) AS p
  FROM d JOIN rules ON contains(s, keyword)
), piece AS (
  SELECT rid, rank, label, weight, unnest(m) AS x, unnest(p[1:len(m)]) AS gap, unnest(range(len(m))) AS i FROM cut WHERE len(m) > 0
), sized AS (
  SELECT *, length(x) - length(replace(x, ' ', '')) AS nx, length(gap) - length(replace(gap, ' ', '')) AS ng FROM piece
), found AS (
  SELECT rid, rank, label, weight, (sum(nx + ng) OVER v - nx)::BIGINT // 2 AS s, (sum(nx + ng) OVER v)::BIGINT // 2 AS e
  FROM sized WINDOW v AS (PARTITION BY rid, rank ORDER BY i)
), swept AS (
  SELECT *, max(e) OVER (PARTITION BY rid ORDER BY s, e DESC, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM found
), near AS (
  SELECT *, lag(e) OVER v AS pe, lag(rank) OVER v AS pr, lead(s) OVER v AS ns, lead(rank) OVER v AS nr
  FROM swept WHERE coalesce(e > far, true) WINDOW v AS (PARTITION BY rid ORDER BY s, e DESC, rank)
), stays AS (
  SELECT rid, label, weight FROM near WHERE NOT coalesce(pe > s AND pr < rank, false) AND NOT coalesce(ns < e AND nr < rank, false)
), parts AS (
  SELECT rid, label, string_split(s, phrase) AS p FROM d JOIN phrases ON contains(s, phrase)
), based AS (
  SELECT rid, label, len(p) - 1 AS n, (length(p[1]) - length(replace(p[1], ' ', ''))) // 2 AS first_word,
         (length(s) - length(replace(s, ' ', '')) - (length(p[-1]) - length(replace(p[-1], ' ', '')))) // 2
           - len(string_split(trim(phrase), '  ')) AS last_word
  FROM (SELECT parts.*, d.s, phrase FROM parts JOIN d USING (rid) JOIN phrases USING (label))
), b AS (
  SELECT rid, sum(n) AS n, min(first_word) AS first_word, max(last_word) AS last_word, string_agg(label, ',' ORDER BY label) AS labels
  FROM based GROUP BY rid
), every AS (
  SELECT rid, label, weight FROM stays UNION ALL SELECT rid, label, {licences.BASE_WEIGHT} FROM based
), a AS (
  SELECT rid, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(weight) AS score FROM every GROUP BY rid
)
SELECT d.doc_id, d.n_words::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word,
       b.last_word::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       coalesce(a.score, 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)
"""


@register("op13_licence_signatures", OP13_SQL)
def op13(spark, sf_dir):
    """Licence and rights notices of every document: base phrases and rules."""
    found = licences.find(read(spark, sf_dir, "documents"))

    def joined(column):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda x: x["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.concat("base", "detections")).alias("labels"), "score")
