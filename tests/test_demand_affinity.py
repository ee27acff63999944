"""Demand series (H6-H8, D16 = D9) and item affinity (H9)."""

import pytest
from pyspark.sql import functions as F

from conftest import D, make_fills
from dosewise.operators import affinity as AF
from dosewise.operators import demand as DM


def _ts(spark, units, item="X", start="2024-01-01"):
    d0 = D(start)
    rows = [(item, d0.fromordinal(d0.toordinal() + i), float(u)) for i, u in enumerate(units)]
    return spark.createDataFrame(rows, "drug_id string, date date, units double")


def test_h6_forward_target(spark):
    ts = _ts(spark, [10, 12, 8, 15, 20, 5, 9, 11])
    r = DM.forward_sum(ts).orderBy("date").collect()
    assert r[0]["target"] == 80
    assert all(x["target"] is None for x in r[1:])


def test_h7_calendar_zero_fill(spark):
    rows = [(1, "A", "2024-01-01", 30, 5.0), (1, "A", "2024-01-04", 30, 7.0), (2, "B", "2024-01-05", 30, 1.0)]
    cal = DM.daily_calendar(make_fills(spark, rows))
    a = cal.filter(F.col("drug_id") == "A").orderBy("date").collect()
    assert [x["units"] for x in a] == [5.0, 0.0, 0.0, 7.0, 0.0]
    assert cal.count() == 10


def test_rolling_needs_full_window(spark):
    ts = _ts(spark, list(range(1, 12)))
    r = DM.with_rolling(ts, sizes=[7]).orderBy("date").collect()
    assert all(x["roll7"] is None for x in r[:7])
    assert r[7]["roll7"] == pytest.approx(sum(range(1, 8)) / 7)


def test_h8_request_features(spark):
    df = spark.createDataFrame([("X", D("2026-06-01"), [float(i) for i in range(1, 30)])],
                               "drug_id string, as_of date, daily_units array<double>")
    r = DM.request_features(df).first()
    assert (r["units"], r["lag_1"], r["lag_7"], r["lag_14"], r["lag_28"]) == (29, 28, 22, 15, 1)
    assert r["roll7"] == pytest.approx(25) and r["roll28"] == pytest.approx(14.5)
    assert (r["dow"], r["month"]) == (0, 6)


def test_request_features_equal_calendar_features(spark):
    """D16 on raw histories equals D9 on the same series."""
    ts = _ts(spark, [(i * 7) % 13 for i in range(60)])
    feats = ["units", "lag_1", "lag_7", "lag_14", "lag_28", "roll7", "roll28", "dow", "month"]
    a = DM.demand_features(ts, dropna=False).filter(F.col("roll28").isNotNull()).select("date", *feats)
    b = DM.request_features(DM.history_requests(ts)).select(F.col("as_of").alias("date"), *feats)
    ra, rb = sorted(a.collect()), sorted(b.collect())
    assert len(ra) == len(rb) > 0
    for x, y in zip(ra, rb):
        assert all((u == pytest.approx(v)) if isinstance(u, float) else u == v for u, v in zip(x, y))


def test_demand_windows_alignment(spark):
    """window = t-28..t-1, target = t..t+6, last full window skipped."""
    ts = _ts(spark, list(range(1, 41)), start="2024-01-01")
    w = DM.demand_windows(ts, split="2100-01-01").orderBy("date").collect()
    first = w[0]
    assert first["date"] == D("2024-01-29")          # t = 28
    assert first["window"] == pytest.approx([float(i) / (20.5) for i in range(1, 29)])
    assert first["target"] * first["scale"] == pytest.approx(sum(range(29, 36)))
    assert len(w) == 40 - 28 - 7                      # range(28, len - 7)


def _h9_pairs(spark):
    return spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (2, "B"), (3, "A"), (4, "C")],
                                 "patient_id long, drug_id string")


def test_h9_lift_table(spark):
    t = {(r["a"], r["b"]): r for r in AF.lift_table(_h9_pairs(spark)).collect()}
    assert t[("A", "B")]["share"] == pytest.approx(2 / 3)
    assert t[("A", "B")]["baseline"] == pytest.approx(0.5)
    assert t[("A", "B")]["lift"] == pytest.approx(4 / 3)
    assert t[("B", "A")]["share"] == pytest.approx(1.0)
    assert t[("B", "A")]["baseline"] == pytest.approx(0.75)
    assert t[("B", "A")]["lift"] == pytest.approx(4 / 3)
    assert ("A", "C") not in t                       # never held together


def test_h9_recommend_thresholds(spark):
    pairs = _h9_pairs(spark)
    lift = AF.lift_table(pairs)
    low = AF.recommend(pairs, lift, min_lift=1.3, min_share=0.2)
    got = {(r["patient_id"], r["suggest"]) for r in low.collect()}
    assert (3, "B") in got
    high = AF.recommend(pairs, lift, min_lift=1.5, min_share=0.2)
    assert high.filter(F.col("patient_id") == 3).count() == 0


def test_care_gap(spark):
    r = AF.care_gap(_h9_pairs(spark), "A", "B").first()
    assert r["patient_id"] == 3
