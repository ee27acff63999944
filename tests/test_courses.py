"""Course history: labels, leak-free features, censoring, ties, skew split
(fixtures H1-H4, H19; traps T1-T3, T8)."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import D, make_fills
from dosewise.operators import courses as C

H1A = [(1, 1, "2024-01-01", 30), (1, 1, "2024-01-31", 30), (1, 1, "2024-03-01", 30), (1, 1, "2024-03-31", 30)]
H1B = [(2, 1, "2024-01-01", 30), (2, 1, "2024-03-12", 30), (2, 1, "2024-05-05", 30), (2, 1, "2024-07-04", 30)]


def _hist(spark, rows, **kw):
    h = C.course_history(make_fills(spark, rows), **kw)
    return [r.asDict() for r in h.orderBy("patient_id", "drug_id", "fill_dt", "l_orderkey").collect()]


def test_h1a_steady_course(spark):
    r = _hist(spark, H1A)
    assert [x["prev_gap"] for x in r] == [30, 30, 30, 30]
    assert [x["was_late"] for x in r] == [0, 0, 0, 0]
    assert [x["came_back"] for x in r] == [1, 1, 1, 0]
    assert [x["fill_number"] for x in r] == [1, 2, 3, 4]
    g = C.with_gaps(make_fills(spark, H1A)).orderBy("fill_dt").collect()
    assert [x["gap"] for x in g] == [None, 30, 30, 30]


def test_h1b_erratic_course(spark):
    r = _hist(spark, H1B)
    assert [x["prev_gap"] for x in r] == [30, 71, 54, 60]
    assert [round(x["avg_gap"], 4) for x in r] == [30, 50.5, 51.6667, 53.75]
    assert [x["was_late"] for x in r] == [0, 1, 1, 1]
    assert [round(x["pct_late"], 4) for x in r] == [0, 0.5, 0.6667, 0.75]
    assert [x["came_back"] for x in r] == [0, 0, 0, 0]


def test_h1c_censoring(spark):
    f = make_fills(spark, H1A + H1B, start_key=1)
    h = C.course_history(f)
    kept = C.censor(h, C.last_day(f)).collect()
    assert len(kept) == 7
    assert not any(r["patient_id"] == 2 and r["fill_dt"] == D("2024-07-04") for r in kept)


def test_h2_grace_boundaries(spark):
    # run-out 2024-01-31; next pickups 14 and 15 days after it
    a = _hist(spark, [(1, 1, "2024-01-01", 30), (1, 1, "2024-02-14", 30)])
    b = _hist(spark, [(2, 1, "2024-01-01", 30), (2, 1, "2024-02-15", 30)])
    assert a[0]["came_back"] == 1 and b[0]["came_back"] == 0
    assert a[1]["prev_gap"] == 44 and a[1]["was_late"] == 0     # 44 is not late
    assert b[1]["prev_gap"] == 45 and b[1]["was_late"] == 1     # 45 is


def test_h4_same_day_ties_stable(spark):
    rows = [(1, 1, "2024-01-01", 30), (1, 1, "2024-01-01", 30), (1, 1, "2024-02-01", 30)]
    r = _hist(spark, rows)
    assert [x["fill_number"] for x in r] == [1, 2, 3]
    assert r[1]["prev_gap"] == 0
    # shuffled input and a different partitioning give the same rows
    f = make_fills(spark, rows)
    shuffled = f.orderBy(F.rand(7)).repartition(3)
    a = C.course_history(f).orderBy("l_orderkey").collect()
    b = C.course_history(shuffled).orderBy("l_orderkey").collect()
    assert a == b


def test_expanding_uses_rows_not_range(spark):
    """A same-day peer must not leak into the current row's mean."""
    rows = [(1, 1, "2024-01-01", 30), (1, 1, "2024-03-01", 30), (1, 1, "2024-03-01", 30)]
    r = _hist(spark, rows)
    assert r[1]["avg_gap"] == pytest.approx((30 + 60) / 2)
    assert r[2]["avg_gap"] == pytest.approx((30 + 60 + 0) / 3)


def plain_history(df):
    """The same by plain windows over whole courses."""
    from pyspark.sql import Window
    w = Window.partitionBy(*C.KEYS).orderBy(*C.ORDER)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    d = df.select("*", F.lead("fill_dt").over(w).alias("next_fill_dt"), F.row_number().over(w).alias("fill_number"),
                  F.coalesce(F.datediff("fill_dt", F.lag("fill_dt").over(w)), "supply_days").cast("double").alias("prev_gap"))
    d = d.withColumn("was_late", (F.col("prev_gap") > F.col("supply_days") + 14).cast("int"))
    d = d.withColumn("days_late", F.datediff("next_fill_dt", F.date_add("fill_dt", F.col("supply_days"))))
    return d.select("*", F.avg("prev_gap").over(past).alias("avg_gap"), F.avg("was_late").over(past).alias("pct_late"),
                    F.coalesce(F.col("days_late") <= 14, F.lit(False)).cast("int").alias("came_back"))


def one_month_course(spark):
    """A course with most rows, all in one month, beside small courses."""
    rng = random.Random(3)
    rows = [(9, 1, f"2024-03-{rng.randint(1, 31):02d}", 30) for _ in range(400)]
    for p in range(1, 6):
        day = D("2023-01-01")
        for _ in range(rng.randint(1, 20)):
            day = day.fromordinal(day.toordinal() + rng.randint(0, 70))
            rows.append((p, rng.choice([1, 2]), day.isoformat(), rng.choice([30, 90])))
    return make_fills(spark, rows)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_course_cut_by_many_ranges_equals_plain_windows(spark, many_ranges):
    f = one_month_course(spark)
    d = C.ranged(f)
    per = [r["count"] for r in d.groupBy(C.RANGE).count().collect()]
    assert len(per) == 12 and max(per) < 120          # the large course is spread
    cols = ["l_orderkey", "fill_number", "prev_gap", "was_late", "avg_gap", "pct_late", "next_fill_dt", "came_back"]
    a = sorted(tuple(x) for x in C.course_history(f).select(*cols).collect())
    b = sorted(tuple(x) for x in plain_history(f).select(*cols).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:4] == y[:4] and x[6:] == y[6:]
        assert x[4] == pytest.approx(y[4]) and x[5] == pytest.approx(y[5])


def test_refill_windows_of_cut_courses_equal_one_range(spark, many_ranges):
    from dosewise.operators import profiles as PR
    f = one_month_course(spark)
    last = F.lit("2024-12-31").cast("date")
    cut = sorted(tuple(r) for r in PR.refill_windows(f, last).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    whole = sorted(tuple(r) for r in PR.refill_windows(f, last).collect())
    assert len(whole) > 390 and cut == whole


def test_no_future_leakage(spark):
    """Cutting the input after day t leaves the features of rows <= t unchanged."""
    rows = H1A + H1B + [(3, 2, "2024-02-10", 90), (3, 2, "2024-06-01", 90), (3, 2, "2024-08-15", 90)]
    f = make_fills(spark, rows)
    cut = D("2024-04-01")
    feats = ["l_orderkey", "prev_gap", "fill_number", "was_late", "avg_gap", "pct_late"]
    full = C.course_history(f).filter(F.col("fill_dt") <= F.lit(cut)).select(*feats)
    part = C.course_history(f.filter(F.col("fill_dt") <= F.lit(cut))).select(*feats)
    assert sorted(full.collect()) == sorted(part.collect())


def test_h19_two_age_rules(spark):
    from dosewise.functions.scalars import age_365, age_calendar
    df = spark.createDataFrame([(D("2024-02-28"), D("2000-02-29")), (D("2023-02-28"), D("2000-02-29"))],
                               "d date, b date")
    r = df.select(age_calendar("d", "b").alias("cal"), age_365("d", "b").alias("d365")).collect()
    assert (r[0]["cal"], r[0]["d365"]) == (23, 24)
    assert r[1]["cal"] == 22


def test_the_facts_are_shuffled_once(spark):
    """Without a large course: one exchange of the facts, no join, no rewrite."""
    rows = [(p, 1, f"2024-{m:02d}-01", 30) for p in range(40) for m in range(1, 4)]
    plan = C.course_history(make_fills(spark, rows).repartition(8))._jdf.queryExecution().executedPlan().toString()
    facts = plan.split("Final Plan")[-1] if "Final Plan" in plan else plan
    assert facts.count("Exchange hashpartitioning(_range") == 1 and "Join" not in facts


def test_a_large_course_on_one_day_with_missing_keys(spark):
    """Bounds fall between rows of the same day; a course without a patient is one."""
    rows = [(9, 1, "2024-03-05", 30)] * 300 + [(p, 1, "2024-03-05", 30) for p in range(1, 9)]
    f = make_fills(spark, rows).withColumn("patient_id", F.when(F.col("patient_id") != 9, F.col("patient_id")))
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        d = C.ranged(f)
        assert d.filter(C.CUT).select(C.RANGE).distinct().count() >= 10
        numbers = sorted(r.fill_number for r in C.course_history(f).filter("patient_id is null").collect())
        assert numbers == list(range(1, 301))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
