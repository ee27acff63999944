"""Queries: exploration aggregates, joins, set operations, sources
(A2-A11, A17, A23, J1, J3, J10, P3, P6, P14, P16, U1-U5, S4, S5, S10, F3, F4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.functions.scalars import age_365, age_calendar
from dosewise.operators import courses as C
from dosewise.operators import profiles as PR
from dosewise.operators import relational as R
from dosewise.plans.q_courses import CENSOR_SQL, GAP_SQL, IDS, WITH_FILLS, WITH_HIST, _fills, _round
from dosewise.plans.registry import DRUGS_SQL, PATIENTS_SQL, register
from dosewise.session import drop_shuffles, stored
from dosewise.sources import adapter as A
from dosewise.sources import tables as T

GAPS_CTE = f"g AS (SELECT {IDS}, supply_days, {GAP_SQL} AS gap FROM fills)"


def _gaps(spark, sf):
    return C.enrich_gaps(_fills(spark, sf))


# --- late rates -------------------------------------------------------------------

@register("late_rate", f"""{WITH_FILLS}, {GAPS_CTE}
SELECT patient_id, round(AVG(CASE WHEN gap > supply_days + 14 THEN 1.0 ELSE 0.0 END), 6) AS late_rate
FROM g WHERE gap IS NOT NULL GROUP BY patient_id""")
def late_rate(spark, sf):
    """A3: per patient, share of refills (first pickups dropped) that were late."""
    g = R.drop_first(_gaps(spark, sf), "gap")
    return _round(R.share_by(g, ["patient_id"], "late", "late_rate"), ["late_rate"])


LATE_RATE_CTE = f"""{WITH_FILLS}, {GAPS_CTE},
rates AS (SELECT patient_id, AVG(CASE WHEN gap > supply_days + 14 THEN 1.0 ELSE 0.0 END) AS late_rate
          FROM g WHERE gap IS NOT NULL GROUP BY patient_id)"""


@register("late_summary", f"""{LATE_RATE_CTE},
overall AS (SELECT AVG(CASE WHEN gap > supply_days + 14 THEN 1.0 ELSE 0.0 END) AS share_late,
                   COUNT(*) AS n_refills FROM g WHERE gap IS NOT NULL)
SELECT round(o.share_late, 6) AS share_late, o.n_refills,
       round(AVG(CASE WHEN r.late_rate = 0 THEN 1.0 ELSE 0.0 END), 6) AS never_late,
       round(AVG(CASE WHEN r.late_rate > 0.5 THEN 1.0 ELSE 0.0 END), 6) AS late_over_half
FROM rates r, overall o GROUP BY o.share_late, o.n_refills""")
def late_summary(spark, sf):
    """Overall share late, patients never late, patients late over half."""
    g = R.drop_first(_gaps(spark, sf), "gap")
    overall = g.agg(F.avg(F.col("late").cast("double")).alias("share_late"),
                    F.count(F.lit(1)).alias("n_refills"))
    rates = R.share_by(g, ["patient_id"], "late", "late_rate")
    per = rates.agg(F.struct(F.avg((F.col("late_rate") == 0).cast("double")).alias("never_late"),
                             F.avg((F.col("late_rate") > 0.5).cast("double")).alias("late_over_half"))).scalar()
    out = overall.select("share_late", "n_refills", per["never_late"].alias("never_late"),
                         per["late_over_half"].alias("late_over_half"))
    return _round(out, ["share_late", "never_late", "late_over_half"])


@register("describe_gap", f"""{WITH_FILLS}, {GAPS_CTE}
SELECT COUNT(gap) AS gap_count, round(AVG(gap), 6) AS gap_mean, round(STDDEV_SAMP(gap), 6) AS gap_std,
       CAST(MIN(gap) AS DOUBLE) AS gap_min, round(quantile_cont(gap, 0.25), 6) AS gap_p25,
       round(quantile_cont(gap, 0.5), 6) AS gap_p50, round(quantile_cont(gap, 0.75), 6) AS gap_p75,
       CAST(MAX(gap) AS DOUBLE) AS gap_max
FROM g""")
def describe_gap(spark, sf):
    """Describe the gap column."""
    d = R.describe(_gaps(spark, sf), "gap", prefix="gap_")
    return _round(d, ["gap_mean", "gap_std", "gap_p25", "gap_p50", "gap_p75"])


@register("label_counts", f"{WITH_HIST} SELECT came_back, COUNT(*) AS n FROM hist GROUP BY came_back")
def label_counts(spark, sf):
    """Value counts of the label."""
    return R.count_by(C.refill_label(_fills(spark, sf)), ["came_back"])


HIST_SQL = """
SELECT CAST(LEAST(COALESCE(CAST(floor((x - lo) / ((hi - lo) / {bins})) AS INTEGER), 0), {bins} - 1) AS INTEGER) AS bin,
       COUNT(*) AS n, MIN(lo) AS lo, MIN(hi) AS hi
FROM src, (SELECT CAST(MIN(x) AS DOUBLE) AS lo, CAST(MAX(x) AS DOUBLE) AS hi FROM src) s
WHERE x IS NOT NULL GROUP BY 1"""


def _hist_sql(src_cte: str, bins: int) -> str:
    return f"""{src_cte},
h AS ({HIST_SQL.format(bins=bins)})
SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS lower,
       round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS upper, n FROM h"""


@register("gap_histogram", _hist_sql(f"{WITH_FILLS}, {GAPS_CTE}, src AS (SELECT CAST(gap AS DOUBLE) AS x FROM g WHERE gap < 200)", 60))
def gap_histogram(spark, sf):
    """60-bin histogram of refill gaps under 200 days."""
    g = R.trim(R.drop_first(_gaps(spark, sf), "gap"), "gap", 200)
    return _round(R.histogram(g.select(F.col("gap").cast("double").alias("gap")), "gap", 60), ["lower", "upper"])


@register("late_rate_histogram", _hist_sql(f"{LATE_RATE_CTE}, src AS (SELECT late_rate AS x FROM rates)", 30))
def late_rate_histogram(spark, sf):
    """30-bin histogram of per-patient late rates."""
    g = R.drop_first(_gaps(spark, sf), "gap")
    rates = R.share_by(g, ["patient_id"], "late", "late_rate")
    return _round(R.histogram(rates, "late_rate", 30), ["lower", "upper"])


# --- joins and dimensions ---------------------------------------------------------

@register("fills_enriched", f"""{WITH_FILLS}, patients AS ({PATIENTS_SQL}), drugs AS ({DRUGS_SQL})
SELECT f.patient_id, f.fill_dt, f.l_orderkey, f.l_linenumber, d.drug_name, d.is_branded, p.birth_dt, p.payer
FROM fills f JOIN drugs d ON f.drug_id = d.drug_id JOIN patients p ON f.patient_id = p.patient_id""")
def fills_enriched(spark, sf):
    """Pickups with drug and patient attributes."""
    f = _fills(spark, sf).select("patient_id", "drug_id", "fill_dt", "l_orderkey", "l_linenumber")
    f = R.enrich(f, A.drugs(spark, sf), "drug_id", ["drug_name", "is_branded"])
    f = R.enrich(f, A.patients(spark, sf), "patient_id", ["birth_dt", "payer"])
    return f.drop("drug_id")


@register("copay_by_insurer", f"""{WITH_FILLS}, patients AS ({PATIENTS_SQL})
SELECT p.payer, COUNT(*) AS n_fills, round(AVG(f.copay), 4) AS mean_copay
FROM fills f JOIN patients p ON f.patient_id = p.patient_id GROUP BY p.payer""")
def copay_by_insurer(spark, sf):
    """Mean copay per payer (fact joined to the payer attribute)."""
    f = R.enrich(_fills(spark, sf).select("patient_id", "copay"), A.patients(spark, sf), "patient_id", ["payer"])
    return f.groupBy("payer").agg(F.count(F.lit(1)).alias("n_fills"),
                                  F.round(F.avg("copay"), 4).alias("mean_copay"))


CONTROLLED_SQL = f"""{WITH_FILLS}, drugs AS ({DRUGS_SQL}),
c AS (SELECT f.* FROM fills f WHERE f.drug_id IN (SELECT drug_id FROM drugs WHERE drug_class > 0))"""


@register("controlled_fills", f"{CONTROLLED_SQL} SELECT {IDS}, supply_days, disp_qty FROM c")
def controlled_fills(spark, sf):
    """Pickups of controlled drugs (semi join on the filtered dimension)."""
    c = R.only_items(_fills(spark, sf), A.drugs(spark, sf), "drug_id", F.col("drug_class") > 0)
    return c.select(*IDS.split(", "), "supply_days", "disp_qty")


@register("frequent_controlled", f"""{CONTROLLED_SQL}
SELECT patient_id, COUNT(*) AS n FROM c GROUP BY patient_id HAVING COUNT(*) >= 8""")
def frequent_controlled(spark, sf):
    """Patients with at least 8 controlled pickups."""
    c = PR.controlled_fills(_fills(spark, sf), A.drugs(spark, sf))
    return R.frequent(c, "patient_id", 8)


# --- ages ------------------------------------------------------------------------

@register("patient_age", f"""{WITH_FILLS}, patients AS ({PATIENTS_SQL})
SELECT f.patient_id, f.fill_dt, f.l_orderkey, f.l_linenumber,
       CAST(trunc((f.fill_dt - p.birth_dt) / 365) AS INTEGER) AS age_365,
       CAST(year(f.fill_dt) - year(p.birth_dt) - CASE WHEN month(f.fill_dt) < month(p.birth_dt)
            OR (month(f.fill_dt) = month(p.birth_dt) AND day(f.fill_dt) < day(p.birth_dt)) THEN 1 ELSE 0 END AS INTEGER)
            AS age_calendar
FROM fills f JOIN patients p ON f.patient_id = p.patient_id""")
def patient_age(spark, sf):
    """age at pickup by days / 365 and by completed calendar years."""
    f = R.enrich(_fills(spark, sf).select("patient_id", "fill_dt", "l_orderkey", "l_linenumber"),
                 A.patients(spark, sf), "patient_id", ["birth_dt"])
    return f.select("patient_id", "fill_dt", "l_orderkey", "l_linenumber",
                    age_365("fill_dt", "birth_dt").alias("age_365"),
                    age_calendar("fill_dt", "birth_dt").alias("age_calendar"))


# --- split ------------------------------------------------------------------------

@register("temporal_split", f"""{WITH_HIST}
SELECT CASE WHEN runout_dt < DATE '{A.SPLIT_DATE}' THEN 'train' ELSE 'test' END AS part,
       COUNT(*) AS n_rows, round(AVG(came_back), 6) AS label_rate
FROM hist WHERE {CENSOR_SQL} GROUP BY 1""")
def temporal_split(spark, sf):
    """Train (run-out before the split day) and test sets of the
    censored label table; rows and label rate of each."""
    from dosewise.plans.q_courses import _lineitem_last
    h = C.censor(C.refill_label(_fills(spark, sf)), _lineitem_last(spark, sf))
    train, test = R.temporal_split(h, "runout_dt", A.SPLIT_DATE)
    agg = lambda d, name: d.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n_rows"),
                                F.round(F.avg("came_back"), 6).alias("label_rate"))
    return R.union(agg(train, "train"), agg(test, "test")).filter(F.col("n_rows") > 0)


# --- set operations ---------------------------------------------------------------

@register("union_fills", f"""{WITH_FILLS}
SELECT drug_id, COUNT(*) AS n FROM (
  SELECT drug_id FROM fills WHERE fill_dt < DATE '{A.SPLIT_DATE}'
  UNION ALL SELECT drug_id FROM fills WHERE fill_dt >= DATE '{A.SPLIT_DATE}') GROUP BY drug_id""")
def union_fills(spark, sf):
    """Union all of the two halves of the pickups, counted per drug (each
    half's day bound is pushed to its scan)."""
    a = A.fills(spark, sf, until=A.SPLIT_DATE).select("drug_id")
    b = A.fills(spark, sf, since=A.SPLIT_DATE).select("drug_id")
    return R.count_by(R.union(a, b), ["drug_id"])


KNOWN_SQL = "known AS (SELECT patient_id FROM c GROUP BY patient_id HAVING COUNT(*) >= 8)"
FLAGGED_SQL = f"""cg AS (SELECT patient_id,
        CAST(fill_dt - LAG(fill_dt) OVER (PARTITION BY patient_id, drug_id ORDER BY fill_dt, l_orderkey, l_linenumber,
             l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS INTEGER) AS gap FROM c),
flagged AS (SELECT patient_id FROM cg GROUP BY patient_id HAVING MIN(gap) < 7)"""


def _known_flagged(spark, sf):
    """Answer key = patients with >= 8 controlled pickups (the reference's
    candidate pool); flagged = controlled patients whose shortest gap is under
    a week."""
    c = PR.controlled_fills(_fills(spark, sf), A.drugs(spark, sf))
    known = R.frequent(c, "patient_id", 8).select("patient_id")
    g = C.with_gaps(c.select(*C.KEYS, "supply_days", *A.ORDER))
    flagged = g.groupBy("patient_id").agg(F.min("gap").alias("m")).filter(F.col("m") < 7).select("patient_id")
    return known, flagged


@register("caught", f"{CONTROLLED_SQL}, {KNOWN_SQL}, {FLAGGED_SQL} SELECT patient_id FROM flagged INTERSECT SELECT patient_id FROM known")
def caught(spark, sf):
    """Flagged patients that are in the answer key."""
    known, flagged = _known_flagged(spark, sf)
    return R.caught(flagged, known)


@register("false_alarms", f"{CONTROLLED_SQL}, {KNOWN_SQL}, {FLAGGED_SQL} SELECT patient_id FROM flagged EXCEPT SELECT patient_id FROM known")
def false_alarms(spark, sf):
    """Flagged patients that are not in the answer key."""
    known, flagged = _known_flagged(spark, sf)
    return R.false_alarms(flagged, known)


@register("table_diff", f"""{WITH_HIST}, t AS (SELECT supply_days, fill_number, CAST(prev_gap AS INTEGER) AS prev_gap,
  was_late, runout_dt, came_back FROM hist WHERE {CENSOR_SQL})
SELECT (SELECT COUNT(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM t)) AS left_only,
       (SELECT COUNT(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM t)) AS right_only,
       (SELECT COUNT(*) FROM t) AS n_rows""")
def table_diff(spark, sf):
    """The DataFrame training table against the SQL one on the columns
    both define the same way; rows only on each side (expected 0, 0)."""
    from dosewise.plans.q_courses import training_table, training_table_sql
    cols = ["supply_days", "fill_number", "prev_gap", "was_late", "runout_dt", "came_back"]
    # written once: compared and counted; its shuffles are gone before those of the other
    a = stored(training_table(spark, sf).select(*cols).withColumn("prev_gap", F.col("prev_gap").cast("int")), "training")
    drop_shuffles(spark)
    b = training_table_sql(spark, sf).select(*cols)
    d = R.table_diff(a, b)
    return d.agg(F.sum(F.when(F.col("side") == "left_only", 1).otherwise(0)).cast("long").alias("left_only"),
                 F.sum(F.when(F.col("side") == "right_only", 1).otherwise(0)).cast("long").alias("right_only")
                 ).select(F.coalesce("left_only", F.lit(0)).alias("left_only"),
                          F.coalesce("right_only", F.lit(0)).alias("right_only"),
                          a.agg(F.count(F.lit(1))).scalar().alias("n_rows"))


# --- sources ----------------------------------------------------------------------

@register("load_counts", f"""{WITH_FILLS}
SELECT 'fills' AS table_name, COUNT(*) AS n_rows, 14 AS n_cols FROM fills
UNION ALL SELECT 'patients', COUNT(*), 4 FROM customer
UNION ALL SELECT 'drugs', COUNT(DISTINCT p_type), 5 FROM part
UNION ALL SELECT 'payers', COUNT(DISTINCT c_mktsegment), 1 FROM customer""")
def load_counts(spark, sf):
    """Row and column counts of the mapped domain tables."""
    return T.table_counts({"fills": _fills(spark, sf), "patients": A.patients(spark, sf),
                           "drugs": A.drugs(spark, sf), "payers": A.payers(spark, sf)})


@register("parse_requests", """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def parse_requests(spark, sf):
    """JSON request text parsed to typed columns with an explicit schema."""
    from pyspark.sql import types as Ty
    ev = A.table(spark, sf, "events").select("event_id", "user_id", "props")
    schema = Ty.StructType([Ty.StructField("k", Ty.IntegerType())])
    return T.parse_requests(ev, schema, "props").select("event_id", "user_id", "k")
