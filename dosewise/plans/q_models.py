"""Queries: model fits, anomaly detection, segments, sequences, tuning,
tracking and scoring (D7, D12, D13, M1-M13, E9-E21, O4, O6, V1, V4).

Model fits and random algorithms have no SQL oracle (rows-only check); the
dataset builders (one-hot, refill windows and their summaries) do.
All fits use the specification's settings; the repeated fits (5-fold CV, the
2 x 3 x 2 grid over 5 folds) train side by side on all rows (``ml.boosting``).
"""

from __future__ import annotations

import uuid
from itertools import product

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from dosewise.ml import models as MD
from dosewise.ml import network as NN
from dosewise.ml import prep as P
from dosewise.ml import tracking as TR
from dosewise.ml import tuning as TU
from dosewise.ml.iforest import IsolationForest
from dosewise.ml.scoring import refill_rules, risk_bands, score_demand, split_valid
from dosewise.operators import demand as D
from dosewise.operators import profiles as PR
from dosewise.operators import relational as R
from dosewise.operators.stats import exact_quantiles, roc_auc
from dosewise.plans.q_courses import (CENSOR_SQL, ORDER_SQL, WITH_FILLS, WITH_HIST, _fills,
                                      _lineitem_last, _round, training_table)
from dosewise.plans.registry import DRUGS_SQL, register
from dosewise.session import drop_shuffles, ensure_checkpoint_dir, stored
from dosewise.sources import adapter as A

SPLIT = A.SPLIT_DATE
CW = f"PARTITION BY patient_id, drug_id ORDER BY {ORDER_SQL}"


def _scratch(spark, name):
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def _training(spark, sf):
    t = stored(P.numeric_view(training_table(spark, sf)), "training")    # both parts are read many times
    drop_shuffles(spark)
    return t


def _split(spark, sf):
    return R.temporal_split(_training(spark, sf), "runout_dt", SPLIT)


def _auc_of(scored):
    return roc_auc(scored).first()["auc"]


# --- dataset builders with oracles ---------------------------------------------------

@register("one_hot", f"""{WITH_HIST}, drugs AS ({DRUGS_SQL}),
tt AS (SELECT d.drug_name, h.runout_dt, h.fill_number FROM hist h JOIN drugs d ON h.drug_id = d.drug_id WHERE {CENSOR_SQL}),
cats AS (SELECT list_sort(list(DISTINCT drug_name)) AS c FROM tt WHERE runout_dt < DATE '{SPLIT}' AND drug_name <> '{A.CONTROLLED_TYPES[0]}')
SELECT t.drug_name, t.runout_dt, t.fill_number,
       list_transform(cats.c, lambda x: CASE WHEN x = t.drug_name THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS drug_name_onehot
FROM tt t, cats WHERE t.runout_dt >= DATE '{SPLIT}'""")
def one_hot(spark, sf):
    """Every test-period row encoded with the categories of the training
    period's uncontrolled drugs; a controlled drug is unseen and gets zeros."""
    t = training_table(spark, sf)
    train, test = R.temporal_split(t, "runout_dt", SPLIT)
    seen = R.exclude(train, "drug_name", A.CONTROLLED_TYPES)
    return P.one_hot(seen, test.select("drug_name", "runout_dt", "fill_number"))


WIN_SQL = f"""{WITH_FILLS},
f0 AS (SELECT *, LEAD(fill_dt) OVER ({CW}) AS next_fill,
              CAST(fill_dt - LAG(fill_dt) OVER ({CW}) AS DOUBLE) / supply_days AS ratio,
              CAST(fill_dt + supply_days AS DATE) AS runout FROM fills),
f1 AS (SELECT *, CASE WHEN next_fill - runout <= 14 THEN 1 ELSE 0 END AS came_back FROM f0
       WHERE runout <= (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem) - 14),
f2 AS (SELECT *, CAST(ROW_NUMBER() OVER ({CW}) - 1 AS INTEGER) AS idx,
              LIST(ratio) OVER ({CW} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS win FROM f1),
wins AS (SELECT patient_id, drug_id, fill_dt, idx, win, came_back, runout FROM f2
         WHERE idx >= 6 AND len(list_filter(win, lambda x: x IS NOT NULL)) = len(win))"""


def _windows(spark, sf):
    return PR.refill_windows(_fills(spark, sf), _lineitem_last(spark, sf))


@register("refill_windows", f"""{WIN_SQL}
SELECT patient_id, drug_id, fill_dt, idx, list_transform(win, lambda x: round(x, 6)) AS "window", came_back, runout FROM wins""")
def refill_windows(spark, sf):
    """Last 6 gap ratios per pickup (index >= 6) with its label."""
    w = _windows(spark, sf)
    return w.withColumn("window", F.transform("window", lambda x: F.round(x, 6)))


@register("refill_window_summary", f"""{WIN_SQL},
s AS (SELECT *, list_avg(win) AS m FROM wins)
SELECT patient_id, drug_id, fill_dt, idx, round(m, 6) AS w_mean,
       round(sqrt(list_sum(list_transform(win, lambda x: (x - m) * (x - m))) / len(win)), 6) AS w_std,
       round(win[6], 6) AS w_last,
       round(len(list_filter(win, lambda x: x > 1.4)) / len(win), 6) AS w_share_over
FROM s""")
def refill_window_summary(spark, sf):
    """Mean, population std, last value and share over 1.4."""
    s = PR.window_summary(_windows(spark, sf))
    return _round(s.select("patient_id", "drug_id", "fill_dt", "idx", "w_mean", "w_std", "w_last", "w_share_over"),
                  ["w_mean", "w_std", "w_last", "w_share_over"])


# --- refill-risk models ---------------------------------------------------------------

@register("lr_scores")
def lr_scores(spark, sf):
    """M1: logistic baseline fit on the training period, scored on the test
    period (score, label per row)."""
    train, test = _split(spark, sf)
    return MD.scores(MD.fit_logistic(train), test)


@register("gbt_scores")
def gbt_scores(spark, sf):
    """M3: boosted trees 300/4/0.05 scored on the test period."""
    train, test = _split(spark, sf)
    return MD.scores(MD.fit_gbt(train, 300, 4, 0.05), test)


@register("importance")
def importance(spark, sf):
    """Global feature importance of the tuned boosted trees (sums to 1)."""
    train, _ = _split(spark, sf)
    return MD.feature_importance(MD.fit_gbt(train, 200, 3, 0.03), spark).orderBy(F.desc("importance"))


@register("score_refills")
def score_refills(spark, sf):
    """Tuned model saved and loaded back, requests validated,
    accepted ones scored and banded."""
    train, test = _split(spark, sf)
    path = TR.save_model(MD.fit_boosted(train, {"tuned": (200, 3, 0.03)})["tuned"], _scratch(spark, "refill-model"))
    model = TR.load_model(path)
    ok, bad = split_valid(test, refill_rules())
    scored = risk_bands(model.transform(ok).withColumn("probability", vector_to_array("probability")[1]))
    return scored.select("drug_name", "fill_number", "pct_late", "refill_probability", "risk", "action", "came_back")


TIME_ORDER = ["runout_dt", "patient_age", "fill_number", "prev_gap", "avg_gap", "pct_late", "drug_name", "came_back"]
GUESSED = {"max_iter": 300, "max_depth": 4, "step": 0.05}
GRID = [{"max_iter": i, "max_depth": d, "step": s} for i, d, s in product([200, 400], [3, 4, 6], [0.03, 0.1])]


@register("cv_scores")
def cv_scores(spark, sf):
    """5 forward folds over the training period in run-out order,
    boosted trees 300/4/0.05."""
    train, _ = _split(spark, sf)
    auc, _ = TU.grid_search(TU.ts_index(train, TIME_ORDER), None, [GUESSED], P.NUMERIC_FEATURES, "drug_name")
    res = [(fold, v) for (_, fold), v in sorted(auc.items())]
    summ = TU.fold_summary(spark, res).first()
    return spark.createDataFrame(res, "fold int, auc double").select(
        "*", F.lit(summ["mean_auc"]).alias("mean_auc"), F.lit(summ["std_auc"]).alias("std_auc"))


@register("grid_search")
def grid_search(spark, sf):
    """The 2 x 3 x 2 grid scored by 5 forward folds, leaderboard
    best first; the best setting trained on the whole training period is
    compared with the guessed one on the test period, saved, loaded and applied
    again (``served_auc``: the loaded model's score)."""
    train, test = _split(spark, sf)
    test = stored(test, "test")
    settings = [*GRID, GUESSED]
    auc, models = TU.grid_search(TU.ts_index(train, TIME_ORDER), test, settings, P.NUMERIC_FEATURES, "drug_name")
    rows = TU.leaderboard_rows(GRID, auc)
    path = TR.save_model(MD.served(models[rows[0]["setting"]]), _scratch(spark, "winner"))
    loaded = _auc_of(MD.scores(TR.load_model(path), test))
    board = TU.leaderboard(spark, rows, 6)
    return board.select("*", F.lit(rows[0]["test_auc"]).alias("best_test_auc"), F.lit(auc[len(GRID), -1]).alias("guessed_test_auc"),
                        F.lit(loaded).alias("served_auc"))


@register("run_log")
def run_log(spark, sf):
    """Three runs logged with params and metrics, the best promoted
    to the registry by its test AUC."""
    from dosewise.operators.metrics import accuracy, class_report
    train, test = (stored(t, "part") for t in _split(spark, sf))
    runs, reg, models = _scratch(spark, "runs"), _scratch(spark, "registry"), _scratch(spark, "models")
    n_feat, n_rows = len(P.NUMERIC_FEATURES) + train.select("drug_name").distinct().count(), train.count()
    boosted = {"gbt-guessed": (300, 4, 0.05), "gbt-tuned": (200, 3, 0.03)}
    fitted = {"logistic-baseline": MD.fit_scaled_logistic(train)} | MD.fit_boosted(train, boosted)
    for name, m in fitted.items():
        params = dict(zip(("n_estimators", "max_depth", "learning_rate"), boosted.get(name, ())))
        s = stored(MD.scores(m, test), "scored")
        f1 = class_report(s).filter(F.col("class") == "1").first()["f1"]
        TR.log_run(spark, runs, name, m, {"model_type": "GBT" if params else "LogisticRegression", **params},
                   {"test_roc_auc": _auc_of(s), "test_accuracy": accuracy(s).first()[0], "test_f1": f1}, n_feat, n_rows, models)
    TR.promote(spark, runs, reg, "refill-risk", served_path=_scratch(spark, "served"))
    return spark.read.parquet(runs).select("run_name", "metrics", "n_features", "n_train_rows").join(
        spark.read.parquet(reg).select("run_name", "version"), "run_name", "left")


# --- demand -----------------------------------------------------------------------------

@register("demand_forecast")
def demand_forecast(spark, sf):
    """Boosted-tree 7-day demand 400/4/0.05 with drug one-hot,
    trained before the split and forecasting the test period."""
    d = stored(D.demand_features(D.daily_calendar(_fills(spark, sf))), "demand")
    train = d.filter(F.col("date") < F.lit(SPLIT).cast("date"))
    test = d.filter(F.col("date") >= F.lit(SPLIT).cast("date"))
    m = MD.fit_demand(train)
    return m.transform(test).select("drug_id", "date", "target", F.col("prediction").alias("forecast"),
                                    (F.col("roll7") * 7).alias("naive"))


@register("score_demand")
def score_demand_q(spark, sf):
    """Demand model applied to raw 29-value request histories."""
    ts = D.daily_calendar(_fills(spark, sf))
    d = D.demand_features(ts)
    m = MD.fit_demand(d.filter(F.col("date") < F.lit(SPLIT).cast("date")))
    req = D.history_requests(ts).filter(F.col("as_of") >= F.lit(SPLIT).cast("date"))
    return score_demand(req, m).select("drug_id", "as_of", "forecast", "forecast_next_7_days", "suggested_order")


@register("window_demand")
def window_demand(spark, sf):
    """Boosted trees on the 28-value windows, unscaled back to units,
    with the last-week naive forecast beside it."""
    w = stored(D.demand_windows(D.daily_calendar(_fills(spark, sf)), SPLIT), "windows")
    m = MD.fit_window_demand(w.filter("is_train"))
    out = m.transform(P.flatten_window(w.filter(~F.col("is_train"))))
    naive = F.aggregate(F.slice("window", -7, 7), F.lit(0.0), lambda a, x: a + x)
    return out.select("drug_id", "date", (F.col("target") * F.col("scale")).alias("units"),
                      (F.col("prediction") * F.col("scale")).alias("forecast"),
                      (naive * F.col("scale")).alias("naive"))


# --- sequences ----------------------------------------------------------------------------

@register("sequence_scores")
def sequence_scores(spark, sf):
    """Four refill models on the same windows - raw 6 values, hand-made
    summaries (boosted trees 200/3/0.03), a perceptron and a gated recurrent
    network - with their test AUCs."""
    w = stored(PR.window_summary(_windows(spark, sf)), "windows")
    train = w.filter(F.col("runout") < F.lit(SPLIT).cast("date"))
    test = w.filter(F.col("runout") >= F.lit(SPLIT).cast("date"))
    rows = []
    for kind in ["raw", "summary", "mlp"]:
        m = MD.fit_sequence(train, kind)
        feats = (F.array("w_mean", "w_std", "w_last", "w_share_over") if kind == "summary" else F.col("window"))
        s = m.transform(test.withColumn("features", array_to_vector(feats))).select(
            vector_to_array("probability")[1].alias("score"), F.col("came_back").alias("label"))
        rows.append((kind, _auc_of(s)))
    net = NN.fit_recurrent(train, "window", "came_back", logistic=True)
    s = NN.recurrent_output(test, net, "window", True, "score").select("score", F.col("came_back").alias("label"))
    rows.append(("recurrent", _auc_of(s)))
    return spark.createDataFrame(rows, "model string, roc_auc double")


# --- segments and anomalies -------------------------------------------------------------

PROFILE_COLS = ["pct_late", "avg_late_ratio", "n_fills", "n_drugs", "avg_copay", "age"]
CONTROLLED_COLS = ["fills", "avg_gap", "min_gap", "pct_early", "avg_early_days", "total_qty"]


def _profiles(spark, sf):
    p = PR.patient_profile(_fills(spark, sf), A.patients(spark, sf), _lineitem_last(spark, sf))
    return stored(MD.standardized_vector(p, PROFILE_COLS), "profiles")


@register("kmeans_sweep")
def kmeans_sweep(spark, sf):
    """Best of 10 seeded k-means fits for k = 2..7, inertia and
    silhouette."""
    rows, _ = MD.kmeans_sweep(_profiles(spark, sf))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def _segments(spark, sf):
    p = _profiles(spark, sf)
    _, models = MD.kmeans_sweep(p, ks=[4])
    return models[4].transform(p)


@register("segments")
def segments(spark, sf):
    """M8: k = 4 segment of every patient."""
    return _segments(spark, sf).select("patient_id", "segment")


@register("segment_summary")
def segment_summary(spark, sf):
    """Size and rounded means per segment."""
    return MD.cluster_summary(_segments(spark, sf), "segment", PROFILE_COLS)


@register("segment_silhouette")
def segment_silhouette(spark, sf):
    """Euclidean silhouette of the k = 4 segments on a seeded sample of 2,000
    patients: rows and mean per segment."""
    z = [c + "_z" for c in PROFILE_COLS]
    s = _segments(spark, sf).withColumn("_x", vector_to_array("features"))
    s = s.select("patient_id", "segment", *[F.col("_x")[i].alias(c) for i, c in enumerate(z)])
    return MD.silhouette_rows(s, z, "segment", ["patient_id"]).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))


@register("segment_coords")
def segment_coords(spark, sf):
    """2-D projection of the standardised profiles with the
    segment (chart data) and the explained variance shares."""
    s = _segments(spark, sf)
    coords, ev = MD.project_2d(s)
    return coords.select("patient_id", "segment", "pc1", "pc2", F.lit(ev[0]).alias("explained_1"),
                         F.lit(ev[1]).alias("explained_2"))


def _controlled(spark, sf):
    drugs = A.drugs(spark, sf)
    cf = PR.controlled_fills(_fills(spark, sf), drugs)
    cf = stored(cf.select("patient_id", "drug_id", "supply_days", "disp_qty", *A.ORDER), "controlled-fills")   # the facts are read once
    c = stored(PR.controlled_profile(cf, drugs), "controlled-profile")
    known = R.frequent(cf, "patient_id", 8)
    z = P.standardize(c, CONTROLLED_COLS, suffix="_z")
    return R.mark_members(z, "patient_id", known, "was_planted")


@register("isolation_scores")
def isolation_scores(spark, sf):
    """Isolation forest (100 trees, 256 samples, 5 % budget) on the
    standardised controlled-drug profiles: oddness, flag, answer-key flag."""
    return isolation_of(stored(_controlled(spark, sf), "controlled"))


def isolation_of(z):
    feats = [c + "_z" for c in CONTROLLED_COLS]
    model = IsolationForest(feats, 100, 256, 0.05, 42).fit(z)
    out = model.transform(z)
    return out.select("patient_id", *CONTROLLED_COLS, "anomaly_score", "oddness", "flagged", "was_planted")


@register("isolation_budget")
def isolation_budget(spark, sf):
    """Forest rule - flagged, caught and false alarms for budgets 1-8 %."""
    from dosewise.operators.metrics import BUDGETS
    z = stored(_controlled(spark, sf), "controlled")
    model = IsolationForest([c + "_z" for c in CONTROLLED_COLS], 100, 256, max(BUDGETS), 42).fit(z)
    scored = stored(model.score(z), "scored")    # fitted and scored once for all budgets
    cuts = exact_quantiles(scored.withColumn("_g", F.lit(0)), ["_g"], "anomaly_score", list(BUDGETS))
    at = cuts.select(F.explode(F.arrays_zip(F.array(*[F.lit(b) for b in BUDGETS]).alias("budget"),
                                            F.col("quantiles").alias("cut"))).alias("c")).select("c.budget", "c.cut")
    hit = scored.join(F.broadcast(at), F.col("anomaly_score") < F.col("cut"))
    return hit.groupBy("budget").agg(F.count(F.lit(1)).alias("flagged"),
                                     F.sum(F.col("was_planted").cast("int")).alias("caught"),
                                     F.sum((~F.col("was_planted")).cast("int")).alias("false_alarms"))


@register("oddest")
def oddest(spark, sf):
    """The 8 oddest flagged patients (lowest oddness first)."""
    from dosewise.operators.relational import top
    return top(isolation_scores(spark, sf).filter("flagged"), "oddness", 8, ["patient_id"], asc=True)


@register("reconstruction_error")
def reconstruction_error(spark, sf):
    """Rebuild error from 2 principal components per patient."""
    z = _controlled(spark, sf)
    v = MD.standardized_vector(z, CONTROLLED_COLS)
    return MD.rebuild_error(v).select("patient_id", "error", "was_planted")


@register("top_error")
def top_error(spark, sf):
    """The 6 patients rebuilt worst."""
    from dosewise.operators.relational import top
    return top(reconstruction_error(spark, sf), "error", 6, ["patient_id"])


@register("network_error")
def network_error(spark, sf):
    """Rebuild error of the 6-4-2-4-6 network beside that of two principal
    components, per patient."""
    v = stored(MD.standardized_vector(_controlled(spark, sf), CONTROLLED_COLS), "vectors")
    linear = MD.rebuild_error(v).withColumnRenamed("error", "linear_error")
    return NN.network_error(linear, NN.fit_bottleneck(v)).select("patient_id", "error", "linear_error", "was_planted")


@register("recurrent_demand")
def recurrent_demand(spark, sf):
    """The gated recurrent network on the 28-value windows, back in units,
    with the last-week naive forecast beside it."""
    w = stored(D.demand_windows(D.daily_calendar(_fills(spark, sf)), SPLIT), "windows")
    net = NN.fit_recurrent(w.filter("is_train"), "window", "target", logistic=False)
    out = NN.recurrent_output(w.filter(~F.col("is_train")), net, "window", False, "forecast")
    naive = F.aggregate(F.slice("window", -7, 7), F.lit(0.0), lambda a, x: a + x)
    return out.select("drug_id", "date", (F.col("target") * F.col("scale")).alias("units"),
                      (F.col("forecast") * F.col("scale")).alias("forecast"), (naive * F.col("scale")).alias("naive"))


# --- per-prediction attributions ------------------------------------------------------------

def _attributions(spark, sf, model=None):
    from dosewise.ml.attribution import attribute
    train, test = _split(spark, sf)
    model = model or MD.fit_gbt(train, 200, 3, 0.03)
    keyed = test.withColumn("_row", F.xxhash64(*[F.col(c) for c in test.columns]))
    names = MD._feature_names(model)
    a = attribute(model, keyed, keep=["_row", *P.NUMERIC_FEATURES, "drug_name", "came_back", "probability"])
    return a.withColumn("probability", vector_to_array("probability")[1]), names


@register("attributions")
def attributions(spark, sf):
    """Additive log-odds attributions of the tuned trees for every row of
    the test period (they sum to each row's log-odds)."""
    a, _ = _attributions(spark, sf)
    return a


@register("attribution_summary")
def attribution_summary(spark, sf):
    """Mean absolute attribution per feature."""
    from dosewise.ml.attribution import attribution_summary as summ
    a, names = _attributions(spark, sf)
    return summ(a, names)


@register("attribution_top")
def attribution_top(spark, sf):
    """The 6 strongest contributions of every explained row."""
    from dosewise.ml.attribution import top_contributions
    a, names = _attributions(spark, sf)
    return top_contributions(a, names).select("_row", "drug_name", "pct_late", "log_odds", "top")


@register("review_queue")
def review_queue(spark, sf):
    """The isolation-forest review queue written in global oddness order
    (range-partitioned sort) to the shared folder and read back."""
    from dosewise.sources.tables import write_ordered
    path = _scratch(spark, "review-queue")
    write_ordered(isolation_scores(spark, sf), [F.col("oddness").asc(), F.col("patient_id").asc()], path)
    return spark.read.parquet(path)
