"""Queries: patient and controlled-drug profiles, drift, and evaluation on a
deterministic stand-in score (A4-A6, A15, A16, A18, D10, D14, D15, E1-E5,
E12, E16, E22-E24, F9, F13, M7, O5, P4, P14, P15, V2, W12, W13).

Evaluation keys score the test period of the training table with
score = 1 - pct_late (rounded to 6 places), so every metric has an exact
oracle before any model exists.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.ml.scoring import risk_bands as bands
from dosewise.operators import courses as C
from dosewise.operators import drift as DR
from dosewise.operators import metrics as M
from dosewise.operators import profiles as PR
from dosewise.operators import relational as R
from dosewise.operators import stats as S
from dosewise.plans.q_courses import (CENSOR_SQL, ORDER_SQL, WITH_FILLS, WITH_HIST, _course_fills, _fills,
                                      _lineitem_last, _round, training_table)
from dosewise.plans.q_explore import CONTROLLED_SQL
from dosewise.plans.registry import PATIENTS_SQL, register
from dosewise.sources import adapter as A

SPLIT = A.SPLIT_DATE
CW = f"PARTITION BY patient_id, drug_id ORDER BY {ORDER_SQL}"


# --- profiles ---------------------------------------------------------------------

@register("patient_profile", f"""{WITH_FILLS}, patients AS ({PATIENTS_SQL}),
g AS (SELECT *, CAST(fill_dt - LAG(fill_dt) OVER ({CW}) AS INTEGER) AS gap FROM fills),
p AS (SELECT patient_id,
        AVG(CASE WHEN gap > supply_days + 14 THEN 1 ELSE 0 END) AS pct_late,
        CAST(SUM((CAST(gap AS BIGINT) * 1000000000) // supply_days) AS DOUBLE) / COUNT(gap) / 1e9 AS avg_late_ratio,
        COUNT(*) AS n_fills, COUNT(DISTINCT drug_id) AS n_drugs, AVG(copay) AS avg_copay
      FROM g GROUP BY patient_id)
SELECT p.patient_id, round(p.pct_late, 6) AS pct_late, round(p.avg_late_ratio, 4) AS avg_late_ratio,
       p.n_fills, p.n_drugs, round(p.avg_copay, 2) AS avg_copay,
       CAST(trunc(((SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem) - pt.birth_dt) / 365) AS INTEGER) AS age
FROM p LEFT JOIN patients pt ON p.patient_id = pt.patient_id
WHERE p.avg_late_ratio IS NOT NULL""")
def patient_profile(spark, sf):
    """Behaviour profile per patient, age at the data's last day."""
    p = PR.patient_profile(_fills(spark, sf), A.patients(spark, sf), _lineitem_last(spark, sf),
                           ratio_scale=10**9)
    p = _round(_round(p, ["pct_late"]), ["avg_late_ratio"], 4)
    return p.withColumn("avg_copay", F.round("avg_copay", 2))


CONTROLLED_PROFILE_SQL = f"""{CONTROLLED_SQL},
cg AS (SELECT *, CAST(fill_dt - LAG(fill_dt) OVER ({CW}) AS INTEGER) AS gap FROM c),
ce AS (SELECT *, CASE WHEN gap IS NULL THEN NULL ELSE greatest(supply_days - gap, 0) END AS early_days,
              CASE WHEN gap < supply_days * CAST(0.75 AS DOUBLE) THEN 1 ELSE 0 END AS is_early FROM cg),
prof AS (SELECT patient_id, COUNT(*) AS fills, AVG(gap) AS avg_gap, MIN(gap) AS min_gap,
                AVG(is_early) AS pct_early, AVG(early_days) AS avg_early_days, SUM(disp_qty) AS total_qty
         FROM ce GROUP BY patient_id HAVING AVG(gap) IS NOT NULL AND AVG(early_days) IS NOT NULL)"""


def _cprof(spark, sf):
    return PR.controlled_profile(_fills(spark, sf), A.drugs(spark, sf))


@register("controlled_profile", f"""{CONTROLLED_PROFILE_SQL}
SELECT patient_id, fills, round(avg_gap, 6) AS avg_gap, min_gap, round(pct_early, 6) AS pct_early,
       round(avg_early_days, 6) AS avg_early_days, total_qty FROM prof""")
def controlled_profile(spark, sf):
    """Controlled-substance pickup profile per patient."""
    return _round(_cprof(spark, sf), ["avg_gap", "pct_early", "avg_early_days"])


@register("early_days", f"""{CONTROLLED_PROFILE_SQL}
SELECT patient_id, drug_id, fill_dt, l_orderkey, l_linenumber, gap, early_days, is_early FROM ce""")
def early_days(spark, sf):
    """Days of supply left at pickup (NULL for the first pickup) and
    the early flag."""
    from dosewise.functions.scalars import clip_low
    c = C.with_gaps(PR.controlled_fills(_course_fills(spark, sf), A.drugs(spark, sf)))
    return c.select("patient_id", "drug_id", "fill_dt", "l_orderkey", "l_linenumber", "gap",
                    clip_low(F.col("supply_days") - F.col("gap"), 0).alias("early_days"),
                    C.early_flag("gap", "supply_days").alias("is_early"))


@register("late_ratio", f"""{WITH_FILLS}
SELECT patient_id, drug_id, fill_dt, l_orderkey, l_linenumber,
       round(CAST(fill_dt - LAG(fill_dt) OVER ({CW}) AS DOUBLE) / supply_days, 6) AS late_ratio FROM fills""")
def late_ratio(spark, sf):
    """gap / supply per pickup (NULL for the first)."""
    from dosewise.functions.scalars import ratio
    g = C.with_gaps(_course_fills(spark, sf))
    return _round(g.select("patient_id", "drug_id", "fill_dt", "l_orderkey", "l_linenumber",
                           ratio("gap", "supply_days").alias("late_ratio")), ["late_ratio"])


@register("planted_flag", f"""{CONTROLLED_PROFILE_SQL},
known AS (SELECT patient_id FROM c GROUP BY patient_id HAVING COUNT(*) >= 8)
SELECT p.patient_id, p.fills, k.patient_id IS NOT NULL AS was_planted
FROM prof p LEFT JOIN known k ON p.patient_id = k.patient_id""")
def planted_flag(spark, sf):
    """Profile rows flagged by membership in the answer key."""
    c = PR.controlled_fills(_fills(spark, sf), A.drugs(spark, sf))
    known = R.frequent(c, "patient_id", 8)
    return R.mark_members(_cprof(spark, sf).select("patient_id", "fills"), "patient_id", known, "was_planted")


STD_COLS = ["fills", "avg_gap", "min_gap", "pct_early", "avg_early_days", "total_qty"]


@register("standardize", f"""{CONTROLLED_PROFILE_SQL}
SELECT patient_id, {', '.join(f"round((CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER (), 6) AS {c}" for c in STD_COLS)}
FROM prof""")
def standardize(spark, sf):
    """Z-scores with the population standard deviation."""
    from dosewise.ml.prep import standardize as z
    return _round(z(_cprof(spark, sf), STD_COLS).select("patient_id", *STD_COLS), STD_COLS)


# --- drift ------------------------------------------------------------------------

NUM = DR.NUMERIC
TT_SQL = f"""{WITH_HIST}, patients AS ({PATIENTS_SQL}),
tt AS (SELECT CAST(trunc((h.fill_dt - p.birth_dt) / 365) AS INTEGER) AS patient_age, h.supply_days, h.fill_number,
              h.prev_gap, h.avg_gap, h.was_late, h.pct_late, h.runout_dt, h.came_back
       FROM hist h JOIN patients p ON h.patient_id = p.patient_id WHERE {CENSOR_SQL}),
u AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, runout_dt >= DATE '{SPLIT}' AS live FROM tt" for c in NUM)}),
qb AS (SELECT feature, value, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY value) - 1 AS idx,
              COUNT(*) OVER (PARTITION BY feature) AS n FROM u WHERE NOT live),
qn AS (SELECT DISTINCT feature, n FROM qb),
qp AS (SELECT * FROM (VALUES {', '.join(f"({i}, CAST('{q!r}' AS DOUBLE))" for i, q in enumerate(DR.cut_probs(10)))}) t(qi, q)),
qv AS (SELECT qn.feature, qp.qi, qn.n, (qn.n - 1) * qp.q AS v FROM qn, qp),
qi2 AS (SELECT feature, qi, v, n, LEAST(GREATEST(CAST(floor(v) AS BIGINT), 0), n - 1) AS lo FROM qv),
qi3 AS (SELECT feature, qi, v - lo AS g, lo, LEAST(lo + 1, n - 1) AS hi FROM qi2),
qx AS (SELECT p.feature, p.qi,
              CASE WHEN p.g >= 0.5 THEN bh.value - (bh.value - bl.value) * (CAST(1 AS DOUBLE) - p.g)
                   ELSE bl.value + (bh.value - bl.value) * p.g END AS qval
       FROM qi3 p JOIN qb bl ON bl.feature = p.feature AND bl.idx = p.lo
                  JOIN qb bh ON bh.feature = p.feature AND bh.idx = p.hi),
q AS (SELECT feature, list_sort(list_distinct(list(qval))) AS cuts FROM qx GROUP BY feature),
cuts AS (SELECT feature, cuts, CASE WHEN len(cuts) >= 2 THEN cuts[2:len(cuts) - 1] ELSE [] END AS interior,
                CAST(len(cuts) - 1 AS INTEGER) AS n_buckets FROM q),
ub AS (SELECT u.feature, u.live, CAST(len(list_filter(c.interior, lambda x: x <= u.value)) AS INTEGER) AS bucket
       FROM u JOIN cuts c ON u.feature = c.feature),
tot AS (SELECT live, COUNT(*) / {len(NUM)} AS n FROM u GROUP BY live),
allb AS (SELECT feature, CAST(unnest(range(0, n_buckets)) AS INTEGER) AS bucket FROM cuts WHERE n_buckets >= 1),
sh AS (SELECT a.feature, a.bucket, s.live,
              greatest(COALESCE((SELECT COUNT(*) FROM ub WHERE ub.feature = a.feature AND ub.bucket = a.bucket
                                 AND ub.live = s.live), 0) / s.n, 1e-6) AS share
       FROM allb a, tot s),
psi AS (SELECT c.feature, COALESCE(SUM((l.share - b.share) * ln(l.share / b.share)), 0) AS psi
        FROM cuts c LEFT JOIN sh b ON b.feature = c.feature AND NOT b.live
        LEFT JOIN sh l ON l.feature = c.feature AND l.live AND l.bucket = b.bucket
        GROUP BY c.feature)"""


def _base_live(spark, sf):
    t = training_table(spark, sf)
    return R.temporal_split(t, "runout_dt", SPLIT)


def _sided(spark, sf):
    """The training table with a ``live`` flag (run-out on/after the split)."""
    t = training_table(spark, sf)
    return t.withColumn("live", F.col("runout_dt") >= F.lit(SPLIT).cast("date"))


@register("psi_cuts", f"""{TT_SQL} SELECT feature, list_transform(cuts, lambda x: round(x, 6)) AS cuts, n_buckets FROM cuts""")
def psi_cuts(spark, sf):
    """Unique decile cut points of the training period per feature."""
    base, _ = _base_live(spark, sf)
    c = DR.psi_cuts(base, NUM)
    return c.select("feature", F.transform("cuts", lambda x: F.round(x, 6)).alias("cuts"), "n_buckets")


@register("psi_buckets", f"{TT_SQL} SELECT feature, bucket, live, round(share, 6) AS share FROM sh")
def psi_buckets(spark, sf):
    """Floored share per bucket, training (live false) and live rows."""
    t = _sided(spark, sf)
    cuts = DR.psi_cuts(t.filter(~F.col("live")), NUM)
    return _round(DR.bucket_shares(t, NUM, cuts, side="live"), ["share"])


@register("psi", f"{TT_SQL} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi(spark, sf):
    """PSI per numeric feature, training period vs live period."""
    return _round(DR.psi_sides(_sided(spark, sf), "live", NUM), ["psi"])


VERDICT_SQL = ("CASE WHEN round(psi, 3) <= 0.1 THEN 'stable' WHEN round(psi, 3) <= 0.25 THEN 'watch' "
               "ELSE 'RETRAIN' END")


@register("drift_report", f"{TT_SQL} SELECT feature, round(psi, 3) AS psi, {VERDICT_SQL} AS verdict FROM psi")
def drift_report(spark, sf):
    """PSI rounded to 3 places and the verdict band."""
    r = DR.psi_sides(_sided(spark, sf), "live", NUM).withColumn("psi", F.round("psi", 3))
    return DR.verdict(r)


@register("drift_alerts", f"{TT_SQL} SELECT feature, round(psi, 3) AS psi FROM psi "
          "WHERE feature NOT IN ('fill_number') AND round(psi, 3) > 0.25")
def drift_alerts(spark, sf):
    """Behavioural features whose PSI exceeds 0.25."""
    r = DR.psi_sides(_sided(spark, sf), "live", NUM).withColumn("psi", F.round("psi", 3))
    return DR.alerts(r)


# --- evaluation on the stand-in score ------------------------------------------------

SCORED_SQL = f"""{TT_SQL},
scored AS (SELECT round(1 - pct_late, 6) AS score, came_back AS label FROM tt WHERE runout_dt >= DATE '{SPLIT}')"""


def _scored(spark, sf):
    _, live = _base_live(spark, sf)
    return live.select(F.round(1 - F.col("pct_late"), 6).alias("score"), F.col("came_back").alias("label"))


@register("accuracy", f"{SCORED_SQL} SELECT round(AVG(CASE WHEN (score >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END), 6) "
          "AS accuracy FROM scored")
def accuracy(spark, sf):
    """Accuracy at the 0.5 cut."""
    return _round(M.accuracy(_scored(spark, sf)), ["accuracy"])


@register("lazy_baseline", f"{SCORED_SQL} SELECT round(AVG(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END), 6) AS lazy_accuracy FROM scored")
def lazy_baseline(spark, sf):
    """M7: accuracy of always answering 1."""
    return _round(M.lazy_baseline(_scored(spark, sf)), ["lazy_accuracy"])


@register("confusion", f"""{SCORED_SQL}
SELECT a.actual, CAST(SUM(CASE WHEN s.label = a.actual AND s.score < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0,
       CAST(SUM(CASE WHEN s.label = a.actual AND s.score >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1
FROM (SELECT 0 AS actual UNION ALL SELECT 1) a, scored s GROUP BY a.actual""")
def confusion(spark, sf):
    """Confusion matrix at 0.5."""
    return M.confusion(_scored(spark, sf))


@register("class_report", f"""{SCORED_SQL},
c AS (SELECT SUM(CASE WHEN label = 0 AND score < 0.5 THEN 1 ELSE 0 END) AS tn,
             SUM(CASE WHEN label = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS fp,
             SUM(CASE WHEN label = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS fn,
             SUM(CASE WHEN label = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS tp FROM scored),
m AS (SELECT CAST(tn AS DOUBLE) / (tn + fn) AS p0, CAST(tn AS DOUBLE) / (tn + fp) AS r0,
             CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1,
             CAST(tn + fp AS DOUBLE) AS s0, CAST(fn + tp AS DOUBLE) AS s1 FROM c),
f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM m),
rows AS (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM f
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM f)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rows""")
def class_report(spark, sf):
    """Per-class precision, recall, F1, support; macro and weighted."""
    return _round(M.class_report(_scored(spark, sf)), ["precision", "recall", "f1"])


@register("threshold_table", f"""{SCORED_SQL}
SELECT CAST(cutoff AS DOUBLE) AS cutoff, CAST(SUM(CASE WHEN score < cutoff THEN 1 ELSE 0 END) AS BIGINT) AS calls,
       CAST(SUM(CASE WHEN score < cutoff AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS caught,
       CAST(SUM(CASE WHEN score >= cutoff AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missed,
       CAST(SUM(CASE WHEN score < cutoff AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wasted
FROM (SELECT unnest([0.4, 0.5, 0.6, 0.7, 0.8]) AS cutoff) c, scored GROUP BY cutoff""")
def threshold_table(spark, sf):
    """Calls, caught, missed, wasted at cut-offs 0.4..0.8."""
    return M.threshold_table(_scored(spark, sf))


RANKS_SQL = f"""{SCORED_SQL},
d AS (SELECT score AS s, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
             CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg FROM scored GROUP BY score),
r AS (SELECT s, n_pos, n_neg,
             CAST(COALESCE(SUM(n_neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS neg_below,
             COALESCE(SUM(n_pos + n_neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               + (n_pos + n_neg + 1) / 2.0 AS avg_rank FROM d)"""


@register("score_ranks", f"{RANKS_SQL} SELECT s, n_pos, n_neg, neg_below, round(avg_rank, 6) AS avg_rank FROM r")
def score_ranks(spark, sf):
    """Per distinct score: counts, negatives below and average rank."""
    return _round(S.score_ranks(_scored(spark, sf)), ["avg_rank"])


@register("roc_auc", f"""{RANKS_SQL}
SELECT round(SUM(n_pos * (neg_below + n_neg / 2.0)) / (SUM(n_pos) * SUM(n_neg)), 6) AS auc FROM r""")
def roc_auc(spark, sf):
    """Exact ROC-AUC, ties counted half."""
    return _round(S.roc_auc(_scored(spark, sf)), ["auc"])


@register("risk_bands", f"""{SCORED_SQL}
SELECT round_even(score, 3) AS refill_probability,
       CASE WHEN score >= 0.7 THEN 'low' WHEN score >= 0.4 THEN 'medium' ELSE 'high' END AS risk,
       CASE WHEN score >= 0.7 THEN 'no action' WHEN score >= 0.4 THEN 'send reminder' ELSE 'pharmacist call' END AS action,
       label FROM scored""")
def risk_bands(spark, sf):
    """Probability to risk band and action."""
    return bands(_scored(spark, sf).withColumnRenamed("score", "probability")).select(
        "refill_probability", "risk", "action", "label")


# --- review budgets ---------------------------------------------------------------

@register("budget_topk", f"""{CONTROLLED_PROFILE_SQL},
ranked AS (SELECT patient_id, round(pct_early, 6) AS score,
                  ROW_NUMBER() OVER (ORDER BY round(pct_early, 6) DESC, patient_id) AS rn FROM prof),
n AS (SELECT COUNT(*) AS n FROM prof)
SELECT CAST(b.budget AS DOUBLE) AS budget, r.patient_id, r.score
FROM (SELECT unnest([0.01, 0.02, 0.03, 0.05, 0.08]) AS budget) b, ranked r, n
WHERE r.rn <= floor(n.n * CAST(b.budget AS DOUBLE))""")
def budget_topk(spark, sf):
    """For each review budget b, the floor(n x b) patients with the
    highest share of early pickups."""
    s = _cprof(spark, sf).select("patient_id", F.round("pct_early", 6).alias("score"))
    return M.budget_topk(s, "patient_id")


@register("review_budget", f"""{CONTROLLED_PROFILE_SQL},
known AS (SELECT patient_id FROM c GROUP BY patient_id HAVING COUNT(*) >= 8),
ranked AS (SELECT patient_id, ROW_NUMBER() OVER (ORDER BY round(pct_early, 6) DESC, patient_id) AS rn FROM prof),
n AS (SELECT COUNT(*) AS n FROM prof),
fl AS (SELECT CAST(b.budget AS DOUBLE) AS budget, r.patient_id FROM (SELECT unnest([0.01, 0.02, 0.03, 0.05, 0.08]) AS budget) b, ranked r, n
       WHERE r.rn <= floor(n.n * CAST(b.budget AS DOUBLE)))
SELECT budget, COUNT(*) AS flagged, COUNT(k.patient_id) AS caught,
       CAST(SUM(CASE WHEN k.patient_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS false_alarms
FROM fl LEFT JOIN known k ON fl.patient_id = k.patient_id GROUP BY budget""")
def review_budget(spark, sf):
    """Flagged, caught and false alarms per review budget (floor
    rule), against the answer key of frequent controlled patients."""
    s = _cprof(spark, sf).select("patient_id", F.round("pct_early", 6).alias("score"))
    c = PR.controlled_fills(_fills(spark, sf), A.drugs(spark, sf))
    return M.review_budget(M.budget_topk(s, "patient_id"), R.frequent(c, "patient_id", 8), "patient_id")


@register("review_quantile", f"""{CONTROLLED_PROFILE_SQL},
known AS (SELECT patient_id FROM c GROUP BY patient_id HAVING COUNT(*) >= 8),
cut AS ({' UNION ALL '.join(f"SELECT CAST({b} AS DOUBLE) AS budget, quantile_cont(avg_gap, {b}) AS cut FROM prof" for b in M.BUDGETS)}),
fl AS (SELECT cut.budget, p.patient_id FROM cut JOIN prof p ON p.avg_gap < cut.cut)
SELECT budget, COUNT(*) AS flagged, COUNT(k.patient_id) AS caught,
       CAST(SUM(CASE WHEN k.patient_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS false_alarms
FROM fl LEFT JOIN known k ON fl.patient_id = k.patient_id GROUP BY budget""")
def review_quantile(spark, sf):
    """The quantile rule (trap T10) - flag scores strictly below the
    budget quantile (lower = odder), here the mean gap."""
    s = _cprof(spark, sf).select("patient_id", F.col("avg_gap").alias("score"))
    c = PR.controlled_fills(_fills(spark, sf), A.drugs(spark, sf))
    return M.review_budget(M.quantile_flags(s, "patient_id"), R.frequent(c, "patient_id", 8), "patient_id")


# --- forward-chaining folds ---------------------------------------------------------

@register("ts_folds", f"""{WITH_HIST},
t AS (SELECT *, ROW_NUMBER() OVER (ORDER BY runout_dt, {ORDER_SQL}) - 1 AS idx FROM hist
      WHERE {CENSOR_SQL} AND runout_dt < DATE '{SPLIT}'),
n AS (SELECT COUNT(*) AS n, COUNT(*) // 6 AS size FROM t),
folds AS (SELECT f AS fold, n.n - 5 * n.size + f * n.size AS test_start, n.size FROM n, range(0, 5) r(f))
SELECT CAST(fold AS INTEGER) AS fold, test_start AS train_rows, size AS test_rows,
       round((SELECT AVG(came_back) FROM t WHERE idx >= test_start AND idx < test_start + size), 6) AS test_label_rate
FROM folds""")
def ts_folds(spark, sf):
    """Forward-chaining folds over the training period in run-out
    order: fold i trains on rows before its test block."""
    from dosewise.ml.tuning import fold_bounds, ts_index
    h = C.censor(C.refill_label(_fills(spark, sf)), _lineitem_last(spark, sf))
    h = h.filter(F.col("runout_dt") < F.lit(SPLIT).cast("date"))
    idx = ts_index(h, ["runout_dt", *A.ORDER])
    b = fold_bounds(idx, 5)
    j = idx.join(F.broadcast(b), (F.col("row_idx") >= F.col("test_start")) &
                 (F.col("row_idx") < F.col("test_start") + F.col("test_rows")))
    rate = j.groupBy("fold").agg(F.round(F.avg("came_back"), 6).alias("test_label_rate"))
    return b.join(rate, "fold", "left").select("fold", F.col("test_start").alias("train_rows"),
                                               "test_rows", "test_label_rate")
