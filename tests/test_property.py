"""Property test: course history on random pickups equals a brute-force
computation of the same rules, for the plain and the hot-course split plan,
whatever the input order."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_fills
from dosewise.operators import courses as C

pickup = st.tuples(st.integers(1, 3), st.sampled_from(["A", "B"]), st.integers(0, 400), st.sampled_from([30, 90]))


def brute(rows, grace=14):
    """rows: (patient, drug, day offset, supply, key) -> {key: features}."""
    out, courses = {}, {}
    for r in rows:
        courses.setdefault((r[0], r[1]), []).append(r)
    for items in courses.values():
        items.sort(key=lambda r: (r[2], r[4]))
        gaps, lates = [], []
        for i, (p, d, day, sup, key) in enumerate(items):
            prev = day - items[i - 1][2] if i else sup
            late = int(prev > sup + grace)
            gaps.append(prev)
            lates.append(late)
            nxt = items[i + 1][2] if i + 1 < len(items) else None
            came = int(nxt is not None and nxt - (day + sup) <= grace)
            out[key] = (i + 1, float(prev), late, sum(gaps) / len(gaps), sum(lates) / len(lates), came)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pickup, min_size=1, max_size=25), st.randoms())
def test_course_history_matches_brute_force(spark, picks, rnd):
    base = dt.date(2024, 1, 1)
    rows = [(p, d, (base + dt.timedelta(days=o)).isoformat(), s) for p, d, o, s in picks]
    order = list(range(len(rows)))
    rnd.shuffle(order)
    shuffled = [rows[i] for i in order]
    f = make_fills(spark, shuffled)
    keyed = [(p, d, o, s, 1 + j) for j, (p, d, o, s) in enumerate(
        [(r[0], r[1], (dt.date.fromisoformat(r[2]) - base).days, r[3]) for r in shuffled])]
    want = brute(keyed)
    for ranges in (1, 8):      # one range, and so many that courses are cut
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = C.course_history(f).select(
            "l_orderkey", "fill_number", "prev_gap", "was_late", "avg_gap", "pct_late", "came_back").collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(got) == len(want)
        for r in got:
            e = want[r["l_orderkey"]]
            assert (r["fill_number"], r["prev_gap"], r["was_late"], r["came_back"]) == (e[0], e[1], e[2], e[5])
            assert r["avg_gap"] == pytest.approx(e[3]) and r["pct_late"] == pytest.approx(e[4])


basket_rows = st.lists(st.tuples(st.integers(1, 12), st.sampled_from(list("ABCDEF"))), min_size=2, max_size=40)


def brute_affinity(pairs, min_lift, min_share):
    baskets = {}
    for p, i in set(pairs):
        baskets.setdefault(p, set()).add(i)
    items = sorted({i for b in baskets.values() for i in b})
    n = len(baskets)
    on = {i: sum(i in b for b in baskets.values()) for i in items}
    both = {(a, b): sum(a in s and b in s for s in baskets.values()) for a in items for b in items if a != b}
    lift = {(a, b): (both[a, b] / on[a]) / (on[b] / n) for (a, b) in both}
    recs = {}
    for p, held in baskets.items():
        for other in items:
            if other in held:
                continue
            best, share, src = 0.0, 0.0, None
            for mine in sorted(held):          # ties: the lowest source item wins
                if lift[mine, other] > best:
                    best, share, src = lift[mine, other], both[mine, other] / on[mine], mine
            if best >= min_lift and share >= min_share:
                recs[(p, other)] = (src, share, best)
    return both, lift, recs


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(basket_rows, st.sampled_from([1.0, 1.3, 1.5]))
def test_affinity_matches_brute_force(spark, rows, min_lift):
    from dosewise.operators import affinity as AF
    df = spark.createDataFrame(sorted(set(rows)), "patient_id long, drug_id string")
    both, lift, recs = brute_affinity(rows, min_lift, 0.2)
    t = {(r["a"], r["b"]): r for r in AF.lift_table(df).collect()}
    assert set(t) == {k for k, n in both.items() if n}
    for k, r in t.items():
        assert r["together"] == both[k] and r["lift"] == pytest.approx(lift[k])
    got = {(r["patient_id"], r["suggest"]): (r["because_of"], r["share"], r["lift"])
           for r in AF.recommend(df, AF.lift_table(df), min_lift, 0.2).collect()}
    assert set(got) == set(recs)
    for k, (src, share, lf) in got.items():
        assert src == recs[k][0] and share == pytest.approx(recs[k][1]) and lf == pytest.approx(recs[k][2])


def psi_numpy(expected, actual, bins=10):
    """Plain-numpy twin of the reference's PSI formula."""
    import numpy as np
    cuts = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    cuts[0], cuts[-1] = -np.inf, np.inf
    e = np.clip(np.histogram(expected, bins=cuts)[0] / len(expected), 1e-6, None)
    a = np.clip(np.histogram(actual, bins=cuts)[0] / len(actual), 1e-6, None)
    return float(np.sum((a - e) * np.log(a / e)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), min_size=3, max_size=80), st.lists(st.integers(0, 40), min_size=1, max_size=80))
def test_psi_matches_numpy(spark, base, live):
    from dosewise.operators import drift as DR
    b = spark.createDataFrame([(float(x),) for x in base], "x double")
    lv = spark.createDataFrame([(float(x),) for x in live], "x double")
    assert DR.psi(b, lv, ["x"]).first()["psi"] == pytest.approx(psi_numpy(base, live), abs=1e-9)
