"""Queries: course history, labels, features, training table (W1-W4, D1-D5, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.operators import courses as C
from dosewise.plans.registry import (CENSOR_SQL, DRUGS_SQL, HISTORY_SQL, ORDER_SQL,
                                     PATIENTS_SQL, fills_sql, register)
from dosewise.plans.training_sql import statement
from dosewise.session import stored
from dosewise.sources import adapter as A

R6 = 6  # rounding of means on both sides of the oracle

def _round(df, cols, n=R6):
    return df.select(*[F.round(c, n).alias(c) if c in cols else F.col(c) for c in df.columns])


def training_table(spark, sf):
    """The flagship model table."""
    fills = A.fills(spark, sf)
    t = C.training_table(fills, A.patients(spark, sf), A.drugs(spark, sf),
                         last=C.last_day(A.table(spark, sf, "lineitem").select(
                             F.col("l_shipdate").cast("date").alias("fill_dt"))))
    return _round(t, ["avg_gap", "pct_late"])


TRAINING_TABLE_SQL = f"""
WITH fills AS ({fills_sql()}),
{HISTORY_SQL},
patients AS ({PATIENTS_SQL}),
drugs AS ({DRUGS_SQL})
SELECT CAST(trunc((h.fill_dt - p.birth_dt) / 365) AS INTEGER) AS patient_age,
       d.drug_name, d.is_branded, h.supply_days, h.fill_number, h.prev_gap,
       h.was_late, round(h.avg_gap, 6) AS avg_gap, round(h.pct_late, 6) AS pct_late,
       h.runout_dt, h.came_back
FROM hist h
JOIN patients p ON h.patient_id = p.patient_id
JOIN drugs d ON h.drug_id = d.drug_id
WHERE {CENSOR_SQL}
"""

register("training_table", TRAINING_TABLE_SQL)(training_table)


# --- shared pieces -------------------------------------------------------------

ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _fills(spark, sf, item="p_type"):
    return A.fills(spark, sf, item)


def _lineitem_last(spark, sf):
    return C.last_day(A.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("fill_dt")))


def _course_fills(spark, sf):
    """The columns that course windows need."""
    return _fills(spark, sf).select(*C.KEYS, "supply_days", *A.ORDER)


def _history(spark, sf):
    return C.course_history(_course_fills(spark, sf))


WITH_FILLS = f"WITH fills AS ({fills_sql()})"
WITH_HIST = f"{WITH_FILLS},\n{HISTORY_SQL}"
IDS = "patient_id, drug_id, fill_dt, l_orderkey, l_linenumber, l_partkey, l_suppkey"


# --- scans ----------------------------------------------------------------------

@register("scan_fills", f"{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty, price, copay, "
          "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM fills")
def scan_fills(spark, sf):
    """The pickup scan with the columns downstream operators use."""
    return _fills(spark, sf).select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty",
                                    "price", "copay", *ROW_ID)


@register("scan_dates", f"{WITH_FILLS} SELECT drug_id, MIN(fill_dt) AS first_dt, MAX(fill_dt) AS last_dt, "
          "COUNT(DISTINCT fill_dt) AS n_days FROM fills GROUP BY drug_id")
def scan_dates(spark, sf):
    """Pickup days parsed to dates; first, last and distinct days per drug."""
    return _fills(spark, sf).groupBy("drug_id").agg(
        F.min("fill_dt").alias("first_dt"), F.max("fill_dt").alias("last_dt"),
        F.countDistinct("fill_dt").alias("n_days"))


@register("project_features", f"{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty FROM fills")
def project_features(spark, sf):
    """An ordered column list."""
    from dosewise.operators.relational import project
    return project(_fills(spark, sf), ["patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty"])


# --- one course -------------------------------------------------------------------

@register("one_course", f"""{WITH_FILLS},
top AS (SELECT patient_id, drug_id FROM fills GROUP BY patient_id, drug_id
        ORDER BY COUNT(*) DESC, patient_id, drug_id LIMIT 1)
SELECT f.patient_id, f.drug_id, f.fill_dt, f.supply_days, f.disp_qty,
       CAST(f.fill_dt - LAG(f.fill_dt) OVER (PARTITION BY f.patient_id, f.drug_id ORDER BY {ORDER_SQL}) AS INTEGER) AS gap
FROM fills f JOIN top t ON f.patient_id = t.patient_id AND f.drug_id = t.drug_id""")
def one_course(spark, sf):
    """The course with the most pickups (ties: lowest patient, drug), as a
    conjunctive equality filter, with gaps."""
    from dosewise.operators.relational import where_all
    f = _fills(spark, sf)
    top = (f.groupBy(*C.KEYS).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "patient_id", "drug_id").limit(1).first())
    # the windows read their input several times: one course, not the facts
    one = stored(where_all(f, patient_id=top["patient_id"], drug_id=top["drug_id"]), "course")
    return C.with_gaps(one).select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty", "gap")


# --- windows ----------------------------------------------------------------------

GAP_SQL = f"CAST(fill_dt - LAG(fill_dt) OVER (PARTITION BY patient_id, drug_id ORDER BY {ORDER_SQL}) AS INTEGER)"


@register("gaps", f"{WITH_FILLS} SELECT {IDS}, {GAP_SQL} AS gap FROM fills")
def gaps(spark, sf):
    """Days since the previous pickup of the course."""
    return C.with_gaps(_course_fills(spark, sf)).select(*IDS.split(", "), "gap")


@register("next_fill", f"{WITH_FILLS} SELECT {IDS}, LEAD(fill_dt) OVER (PARTITION BY patient_id, drug_id "
          f"ORDER BY {ORDER_SQL}) AS next_fill_dt FROM fills")
def next_fill(spark, sf):
    """Day of the next pickup of the course."""
    return C.next_date(_course_fills(spark, sf)).select(*IDS.split(", "), "next_fill_dt")


@register("fill_number", f"{WITH_FILLS} SELECT {IDS}, CAST(ROW_NUMBER() OVER (PARTITION BY patient_id, drug_id "
          f"ORDER BY {ORDER_SQL}) AS INTEGER) AS fill_number FROM fills")
def fill_number(spark, sf):
    """1-based pickup number in the course."""
    return C.ordinal(_course_fills(spark, sf)).select(*IDS.split(", "), "fill_number")


@register("expanding_history", f"{WITH_HIST} SELECT {IDS}, round(avg_gap, 6) AS avg_gap, "
          "round(pct_late, 6) AS pct_late FROM hist")
def expanding_history(spark, sf):
    """Expanding means of gap and late flag (ROWS frame)."""
    return _round(_history(spark, sf).select(*IDS.split(", "), "avg_gap", "pct_late"), ["avg_gap", "pct_late"])


@register("late_flag", f"""{WITH_FILLS}, g AS (SELECT {IDS}, supply_days, {GAP_SQL} AS gap FROM fills)
SELECT {IDS}, gap, CASE WHEN gap > supply_days + 14 THEN 1 ELSE 0 END AS late FROM g""")
def late_flag_q(spark, sf):
    """Late when the gap exceeds supply + 14."""
    return C.enrich_gaps(_course_fills(spark, sf)).select(*IDS.split(", "), "gap", "late")


@register("early_flag", f"""{WITH_FILLS}, g AS (SELECT {IDS}, supply_days, {GAP_SQL} AS gap FROM fills)
SELECT {IDS}, gap, CASE WHEN gap < supply_days * CAST(0.75 AS DOUBLE) THEN 1 ELSE 0 END AS is_early FROM g""")
def early_flag_q(spark, sf):
    """Early when the gap is under 0.75 x supply."""
    g = C.with_gaps(_course_fills(spark, sf))
    return g.select(*IDS.split(", "), "gap", C.early_flag("gap", "supply_days").alias("is_early"))


@register("gaps_only", f"""{WITH_FILLS}, g AS (SELECT {IDS}, {GAP_SQL} AS gap FROM fills)
SELECT * FROM g WHERE gap IS NOT NULL""")
def gaps_only(spark, sf):
    """P5: refills only (first pickups dropped)."""
    from dosewise.operators.relational import drop_first
    return drop_first(C.with_gaps(_course_fills(spark, sf)).select(*IDS.split(", "), "gap"), "gap")


@register("label", f"{WITH_HIST} SELECT {IDS}, next_fill_dt, runout_dt, days_late, came_back FROM hist")
def label(spark, sf):
    """Next pickup, run-out day, days late and the label."""
    return C.refill_label(_course_fills(spark, sf)).select(*IDS.split(", "), "next_fill_dt", "runout_dt",
                                                    "days_late", "came_back")


@register("runout", f"{WITH_FILLS} SELECT {IDS}, CAST(fill_dt + supply_days AS DATE) AS runout_dt FROM fills")
def runout_q(spark, sf):
    """run-out day = pickup day + supply days."""
    from dosewise.functions.scalars import runout
    return _fills(spark, sf).select(*IDS.split(", "), runout("fill_dt", "supply_days").alias("runout_dt"))


@register("censored", f"{WITH_HIST} SELECT {IDS}, runout_dt, came_back FROM hist WHERE {CENSOR_SQL}")
def censored(spark, sf):
    """P10/A10: labels with run-out inside the last 14 days dropped."""
    h = C.refill_label(_course_fills(spark, sf))
    return C.censor(h, _lineitem_last(spark, sf)).select(*IDS.split(", "), "runout_dt", "came_back")


@register("prev_gap", f"{WITH_HIST} SELECT {IDS}, prev_gap FROM hist")
def prev_gap(spark, sf):
    """Previous gap, filled from the supply days for first pickups."""
    from dosewise.operators.relational import fill_from
    g = C.with_gaps(_course_fills(spark, sf), out="prev_gap").withColumn("prev_gap", F.col("prev_gap").cast("double"))
    return fill_from(g, "prev_gap", "supply_days").select(
        *IDS.split(", "), F.col("prev_gap").cast("double").alias("prev_gap"))


@register("refill_features", f"{WITH_HIST} SELECT {IDS}, prev_gap, fill_number, was_late, "
          "round(avg_gap, 6) AS avg_gap, round(pct_late, 6) AS pct_late FROM hist")
def refill_features(spark, sf):
    """D3: the leak-free features of every pickup."""
    h = C.refill_features(_course_fills(spark, sf))
    return _round(h.select(*IDS.split(", "), "prev_gap", "fill_number", "was_late", "avg_gap", "pct_late"),
                  ["avg_gap", "pct_late"])


@register("first_fill", f"""{WITH_FILLS}
SELECT patient_id, drug_id, fill_dt, disp_qty, l_orderkey, l_linenumber FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY patient_id, drug_id ORDER BY {ORDER_SQL}) AS rn FROM fills) WHERE rn = 1""")
def first_fill(spark, sf):
    """First pickup of every course."""
    from dosewise.operators.relational import first_row
    f = _fills(spark, sf).select("patient_id", "drug_id", *A.ORDER, "disp_qty")
    return first_row(f, C.KEYS, A.ORDER).select("patient_id", "drug_id", "fill_dt", "disp_qty",
                                                "l_orderkey", "l_linenumber")


# --- training table in SQL (D5) ------------------------------------------------------

TRAINING_STATEMENT_SQL = statement(
    "CAST({later} - {earlier} AS INTEGER)", "CAST({d} + CAST({n} AS INTEGER) AS DATE)", "strftime({d}, '%m%d')",
    f"({fills_sql()}) f", f"(SELECT drug_id, drug_name, is_branded FROM ({DRUGS_SQL})) d",
    f"(SELECT patient_id, birth_dt FROM ({PATIENTS_SQL})) p", "(SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)")


@register("training_table_sql", TRAINING_STATEMENT_SQL)
def training_table_sql(spark, sf):
    """The training table as one Spark SQL statement."""
    from dosewise.plans.training_sql import training_table_sql as run
    return run(spark, A.fills(spark, sf), A.patients(spark, sf), A.drugs(spark, sf),
               A.table(spark, sf, "lineitem"))


@register("fills_head", f"{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty, l_orderkey, "
          f"l_linenumber FROM fills ORDER BY patient_id, drug_id, {ORDER_SQL} LIMIT 5")
def fills_head(spark, sf):
    """O3: the first five pickups in (patient, drug, day, line) order."""
    from dosewise.operators.relational import head
    f = _fills(spark, sf)
    return head(f, 5, ["patient_id", "drug_id", *A.ORDER]).select(
        "patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty", "l_orderkey", "l_linenumber")
