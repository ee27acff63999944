"""Metrics, PSI, verdicts, folds, bands, validation, budgets, one-hot,
refill windows (H5, H10-H18, H20)."""

import pytest
from pyspark.sql import functions as F

from conftest import make_fills
from dosewise.ml import prep as P
from dosewise.ml import scoring as SC
from dosewise.ml import tuning as TU
from dosewise.operators import drift as DR
from dosewise.operators import metrics as M
from dosewise.operators import profiles as PR
from dosewise.operators import stats as S


def _scored(spark, pairs):
    return spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "score double, label int")


def test_h10_auc_accuracy_thresholds(spark):
    s = _scored(spark, [(0.3, 0), (0.45, 1), (0.55, 0), (0.9, 1)])
    assert S.roc_auc(s).first()["auc"] == pytest.approx(0.75)
    assert M.accuracy(s).first()["accuracy"] == pytest.approx(0.5)
    t = {r["cutoff"]: r for r in M.threshold_table(s).collect()}
    assert (t[0.5]["calls"], t[0.5]["caught"], t[0.5]["wasted"], t[0.5]["missed"]) == (2, 1, 1, 1)
    cm = {r["actual"]: (r["pred_0"], r["pred_1"]) for r in M.confusion(s).collect()}
    assert cm == {0: (1, 1), 1: (1, 1)}


def test_h11_all_ties_auc_half(spark):
    s = _scored(spark, [(0.5, 0), (0.5, 1), (0.5, 1), (0.5, 0), (0.5, 0)])
    assert S.roc_auc(s).first()["auc"] == pytest.approx(0.5)


def test_auc_matches_pairwise_brute_force(spark):
    import random
    rng = random.Random(5)
    pairs = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(300)]
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert S.roc_auc(_scored(spark, pairs)).first()["auc"] == pytest.approx(brute)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(1).integers(0, 50, 501)]
    df = spark.createDataFrame([(0, v) for v in vals], "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = S.exact_quantiles(df, ["g"], "v", probs).first()["quantiles"]
    assert q == pytest.approx(list(np.quantile(vals, probs)))


def _psi(spark, base, live):
    b = spark.createDataFrame([(float(x),) for x in base], "x double")
    lv = spark.createDataFrame([(float(x),) for x in live], "x double")
    return DR.psi(b, lv, ["x"]).first()["psi"]


def test_h12_psi_cases(spark):
    xs = [1, 5, 2, 8, 3, 9, 4, 4, 7, 6, 10, 2]
    assert _psi(spark, xs, xs) == pytest.approx(0.0, abs=1e-12)
    assert _psi(spark, [0] * 25 + [1] * 76, [0] * 70 + [1] * 5) == pytest.approx(0.0)
    assert _psi(spark, [0, 0, 1, 1], [1, 1, 1, 0]) == pytest.approx(0.27465, abs=1e-5)
    assert _psi(spark, [3, 3, 3], [1, 2, 3]) == pytest.approx(0.0)


def test_h13_verdict_bands(spark):
    df = spark.createDataFrame([(0.10,), (0.1001,), (0.25,), (0.2501,)], "psi double")
    assert [r["verdict"] for r in DR.verdict(df).collect()] == ["stable", "watch", "watch", "RETRAIN"]


def test_h14_fold_bounds(spark):
    df = spark.range(14).withColumnRenamed("id", "t")
    idx = TU.ts_index(df, ["t"])
    assert sorted(r["row_idx"] for r in idx.collect()) == list(range(14))
    b = TU.fold_bounds(idx, 5).orderBy("fold").collect()
    assert [r["test_start"] for r in b] == [4, 6, 8, 10, 12]
    assert all(r["test_rows"] == 2 for r in b)


def test_global_index_is_total_order(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5000).repartition(7)
    idx = TU.ts_index(df.select("k"), ["k"])
    assert all(r["k"] == r["row_idx"] for r in idx.collect())


def test_h15_risk_bands(spark):
    df = spark.createDataFrame([(0.70,), (0.6999,), (0.40,), (0.3999,)], "probability double")
    assert [r["risk"] for r in SC.risk_bands(df).collect()] == ["low", "medium", "medium", "high"]


def test_h16_validation(spark):
    df = spark.createDataFrame([(30, 0, 5.0, 29), (30, 0, 0.5, 28), (30, 1, 0.5, 29)],
                               "patient_age int, was_late int, pct_late double, n int")
    rules = SC.refill_rules()
    rules["daily_units must hold 29 values"] = F.col("n") == 29
    ok, bad = SC.split_valid(df, rules)
    assert ok.count() == 1 and bad.count() == 2
    assert all(r["reason"] for r in bad.collect())


def test_h17_floor_rule_budget(spark):
    s = spark.range(296).select(F.col("id").alias("pid"), (F.col("id") * 1.0).alias("score"))
    got = {r["budget"]: r["n"] for r in M.budget_topk(s, "pid").groupBy("budget").agg(F.count("*").alias("n")).collect()}
    assert [got[b] for b in M.BUDGETS] == [2, 5, 8, 14, 23]


def test_h18_unseen_category(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "drug_name string")
    test = spark.createDataFrame([("a",), ("zz",), ("c",)], "drug_name string")
    r = {x["drug_name"]: x["drug_name_onehot"] for x in P.one_hot(train, test).collect()}
    assert r["a"] == [1.0, 0.0, 0.0] and r["c"] == [0.0, 0.0, 1.0] and r["zz"] == [0.0, 0.0, 0.0]


def test_h5_controlled_profile(spark):
    fills = make_fills(spark, [(1, "PROMO", "2024-01-01", 30), (1, "PROMO", "2024-01-11", 30),
                               (1, "PROMO", "2024-02-20", 30)])
    drugs = spark.createDataFrame([("PROMO", 5)], "drug_id string, drug_class int")
    r = PR.controlled_profile(fills, drugs).first()
    assert r["pct_early"] == pytest.approx(1 / 3)
    assert r["avg_early_days"] == pytest.approx(10)
    assert r["min_gap"] == 10


def test_h20_refill_windows(spark):
    rows = [(1, "X", f"2024-{m:02d}-01", 30) for m in range(1, 9)]
    w = PR.refill_windows(make_fills(spark, rows), F.lit("2030-01-01").cast("date"))
    assert sorted(r["idx"] for r in w.collect()) == [6, 7]
