"""Queries: baskets, co-occurrence, lift and recommendations
(U4, A2, A12-A14, J4-J8, M14, M15, O2, O8, F21).

Items are part brands (25); a basket is everything a patient ever picked up.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.operators import affinity as AF
from dosewise.plans.q_courses import _round
from dosewise.plans.registry import fills_sql, register
from dosewise.session import stored
from dosewise.sources import adapter as A

MIN_LIFT, MIN_SHARE = 1.5, 0.20
ANY_LIFT = 1.0       # a second setting, under which random data gives suggestions too
HAS, LACKS = "Brand#11", "Brand#12"

PAIRS_SQL = f"""WITH fills AS ({fills_sql('p_brand')}),
pairs AS (SELECT DISTINCT patient_id, drug_id FROM fills)"""
LIFT_SQL = f"""{PAIRS_SQL},
on_item AS (SELECT drug_id, COUNT(*) AS on_item FROM pairs GROUP BY drug_id),
npat AS (SELECT COUNT(DISTINCT patient_id) AS n FROM pairs),
pc AS (SELECT x.drug_id AS a, y.drug_id AS b, COUNT(*) AS together FROM pairs x JOIN pairs y
       ON x.patient_id = y.patient_id AND x.drug_id <> y.drug_id GROUP BY 1, 2),
lift AS (SELECT pc.a, pc.b, pc.together, pc.together / oa.on_item AS share,
                ob.on_item / (SELECT n FROM npat) AS baseline,
                (pc.together / oa.on_item) / (ob.on_item / (SELECT n FROM npat)) AS lift
         FROM pc JOIN on_item oa ON oa.drug_id = pc.a JOIN on_item ob ON ob.drug_id = pc.b)"""


def _pairs(spark, sf):
    """All distinct (patient, item) pairs, written once: one fact scan."""
    return stored(AF.patient_items(A.fills(spark, sf, "p_brand")), "pairs")


def _lift(spark, sf):
    return AF.lift_table(_pairs(spark, sf))


@register("patient_drug", f"{PAIRS_SQL} SELECT * FROM pairs")
def patient_drug(spark, sf):
    """U4: distinct (patient, item) pairs."""
    return _pairs(spark, sf)


@register("baskets", f"{PAIRS_SQL} SELECT patient_id, list_sort(list(drug_id)) AS items FROM pairs GROUP BY patient_id")
def baskets(spark, sf):
    """Sorted item set per patient."""
    return AF.baskets(_pairs(spark, sf))


@register("on_drug", f"{PAIRS_SQL} SELECT drug_id, COUNT(*) AS on_item FROM pairs GROUP BY drug_id")
def on_drug(spark, sf):
    """A2: patients per item."""
    return AF.on_item(_pairs(spark, sf))


@register("pair_counts", f"{LIFT_SQL} SELECT a, b, together FROM pc")
def pair_counts(spark, sf):
    """Patients holding both items, every ordered pair that occurs."""
    return AF.pair_counts(_pairs(spark, sf))


@register("lift_table", f"{LIFT_SQL} SELECT a, b, together, round(share, 6) AS share, "
          "round(baseline, 6) AS baseline, round(lift, 6) AS lift FROM lift")
def lift_table(spark, sf):
    """Share, baseline and lift per ordered pair."""
    return _round(_lift(spark, sf), ["share", "baseline", "lift"])


@register("top_lift", f"{LIFT_SQL} SELECT a, b, round(lift, 6) AS lift FROM lift ORDER BY lift DESC, a, b LIMIT 8")
def top_lift(spark, sf):
    """O2: the 8 strongest connections."""
    from dosewise.operators.relational import top
    return _round(top(_lift(spark, sf), "lift", 8, ["a", "b"]).select("a", "b", "lift"), ["lift"])


@register("candidate_items", f"""{LIFT_SQL}
SELECT DISTINCT p.patient_id, l.b AS drug_id FROM pairs p JOIN lift l ON l.a = p.drug_id
WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.patient_id = p.patient_id AND q.drug_id = l.b)""")
def candidate_items(spark, sf):
    """Items a patient does not hold but that co-occur with one they hold
    (equi join to the pair table; held items are told by a link to themselves)."""
    pairs = _pairs(spark, sf)
    links = AF.pair_counts(pairs).select("a", "b", F.lit(1).alias("_link"))
    return AF.least_link(pairs, links).select("patient_id", F.col("b").alias("drug_id"))


def _recommend_sql(min_lift):
    return f"""{LIFT_SQL},
links AS (SELECT p.patient_id, l.a, l.b, l.share, l.lift FROM pairs p JOIN lift l ON l.a = p.drug_id
          WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.patient_id = p.patient_id AND q.drug_id = l.b)),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY patient_id, b ORDER BY lift DESC, a) AS rn FROM links)
SELECT patient_id, b AS suggest, a AS because_of, round(share, 6) AS share, round(lift, 6) AS lift
FROM best WHERE rn = 1 AND lift >= {min_lift} AND share >= {MIN_SHARE}"""


def _recommend(spark, sf, min_lift):
    pairs = _pairs(spark, sf)
    return _round(AF.recommend(pairs, AF.lift_table(pairs), min_lift, MIN_SHARE), ["share", "lift"])


@register("recommendations", _recommend_sql(MIN_LIFT))
def recommendations(spark, sf):
    """For every patient, items not held whose strongest link passes
    the lift and share thresholds (1.5 and 0.2)."""
    return _recommend(spark, sf, MIN_LIFT)


@register("recommendations_any_lift", _recommend_sql(ANY_LIFT))
def recommendations_any_lift(spark, sf):
    """M15/J8 with links of lift 1 and more."""
    return _recommend(spark, sf, ANY_LIFT)


@register("care_gap", f"""{PAIRS_SQL}
SELECT MIN(patient_id) AS patient_id FROM pairs WHERE drug_id = '{HAS}'
AND patient_id NOT IN (SELECT patient_id FROM pairs WHERE drug_id = '{LACKS}')""")
def care_gap(spark, sf):
    """The first patient holding one item and lacking another."""
    return AF.care_gap(_pairs(spark, sf), HAS, LACKS)
