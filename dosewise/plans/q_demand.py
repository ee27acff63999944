"""Queries: daily demand calendar, features, windows and request scoring
(A1, A22, J7, D8, D9, D11, D16, W5-W8, O10, M6, E7, E8, F5, F6, F8, V3, V5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.operators import demand as D
from dosewise.operators import metrics as M
from dosewise.plans.q_courses import WITH_FILLS, _fills, _round
from dosewise.plans.registry import register
from dosewise.sources import adapter as A

SPLIT = A.SPLIT_DATE

# The dense calendar as SQL: items x days between the data's first and last day.
TS_SQL = f"""{WITH_FILLS},
daily AS (SELECT drug_id, fill_dt AS date, SUM(disp_qty) AS units FROM fills GROUP BY drug_id, fill_dt),
bounds AS (SELECT MIN(fill_dt) AS lo, MAX(fill_dt) AS hi FROM fills),
items AS (SELECT DISTINCT drug_id FROM daily),
cal AS (SELECT drug_id, CAST(d AS DATE) AS date FROM (
          SELECT i.drug_id, unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
          FROM items i, bounds b)),
ts AS (SELECT c.drug_id, c.date, COALESCE(d.units, 0.0) AS units
       FROM cal c LEFT JOIN daily d ON c.drug_id = d.drug_id AND c.date = d.date)"""

SW = "PARTITION BY drug_id ORDER BY date"


def _roll_sql(k):
    f = f"OVER ({SW} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN COUNT(units) {f} = {k} THEN AVG(units) {f} END"


TARGET_SQL = (f"CASE WHEN COUNT(units) OVER ({SW} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) = 7 "
              f"THEN SUM(units) OVER ({SW} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) END")

FEAT_SQL = f"""{TS_SQL},
feat AS (SELECT drug_id, date, units,
    LAG(units, 1) OVER ({SW}) AS lag_1, LAG(units, 7) OVER ({SW}) AS lag_7,
    LAG(units, 14) OVER ({SW}) AS lag_14, LAG(units, 28) OVER ({SW}) AS lag_28,
    {_roll_sql(7)} AS roll7, {_roll_sql(28)} AS roll28,
    CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
    {TARGET_SQL} AS target FROM ts),
data AS (SELECT * FROM feat WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL AND lag_14 IS NOT NULL
         AND lag_28 IS NOT NULL AND roll7 IS NOT NULL AND roll28 IS NOT NULL AND target IS NOT NULL)"""

FEATS = ["units", "lag_1", "lag_7", "lag_14", "lag_28", "roll7", "roll28"]


def _ts(spark, sf):
    return D.daily_calendar(_fills(spark, sf))


@register("daily_units", f"{WITH_FILLS} SELECT drug_id, fill_dt, SUM(disp_qty) AS units FROM fills GROUP BY drug_id, fill_dt")
def daily_units(spark, sf):
    """A1: units per drug and day."""
    return D.daily_units(_fills(spark, sf))


@register("daily_calendar", f"{TS_SQL} SELECT * FROM ts")
def daily_calendar(spark, sf):
    """Dense calendar, zero on quiet days."""
    return _ts(spark, sf)


@register("demand_lags", f"""{TS_SQL} SELECT drug_id, date, units,
    LAG(units, 1) OVER ({SW}) AS lag_1, LAG(units, 7) OVER ({SW}) AS lag_7,
    LAG(units, 14) OVER ({SW}) AS lag_14, LAG(units, 28) OVER ({SW}) AS lag_28 FROM ts""")
def demand_lags(spark, sf):
    """Lags 1, 7, 14, 28 days."""
    return D.with_lags(_ts(spark, sf))


@register("demand_rolling", f"""{TS_SQL} SELECT drug_id, date, units, round({_roll_sql(7)}, 6) AS roll7,
    round({_roll_sql(28)}, 6) AS roll28 FROM ts""")
def demand_rolling(spark, sf):
    """Trailing 7- and 28-day means, today excluded, NULL until full."""
    return _round(D.with_rolling(_ts(spark, sf)), ["roll7", "roll28"])


@register("demand_target", f"{TS_SQL} SELECT drug_id, date, units, {TARGET_SQL} AS target FROM ts")
def demand_target(spark, sf):
    """Sum of the next 7 days, NULL until 7 exist."""
    return D.forward_sum(_ts(spark, sf))


@register("demand_features", f"{FEAT_SQL} SELECT drug_id, date, units, lag_1, lag_7, lag_14, lag_28, "
          "round(roll7, 6) AS roll7, round(roll28, 6) AS roll28, dow, month, target FROM data")
def demand_features(spark, sf):
    """The model table for 7-day demand."""
    return _round(D.demand_features(_ts(spark, sf)), ["roll7", "roll28"])


@register("calendar_parts", f"{TS_SQL} SELECT DISTINCT date, CAST(isodow(date) - 1 AS INTEGER) AS dow, "
          "CAST(month(date) AS INTEGER) AS month FROM ts")
def calendar_parts(spark, sf):
    """weekday (Monday 0) and month of every calendar day."""
    from dosewise.functions.scalars import dow, month
    return _ts(spark, sf).select("date").distinct().select("date", dow("date").alias("dow"),
                                                             month("date").alias("month"))


@register("drop_incomplete", f"""{FEAT_SQL}
SELECT f.drug_id, COUNT(*) AS n_before, (SELECT COUNT(*) FROM data d WHERE d.drug_id = f.drug_id) AS n_after
FROM feat f GROUP BY f.drug_id""")
def drop_incomplete(spark, sf):
    """Rows per drug before and after dropping incomplete rows."""
    from dosewise.operators.relational import drop_incomplete as dropna
    full = D.demand_features(_ts(spark, sf), dropna=False)
    before = full.groupBy("drug_id").agg(F.count(F.lit(1)).alias("n_before"))
    after = dropna(full).groupBy("drug_id").agg(F.count(F.lit(1)).alias("n_after"))
    return before.join(after, "drug_id", "left").select(
        "drug_id", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))


TEST_SQL = f"{FEAT_SQL}, test AS (SELECT *, roll7 * 7 AS naive FROM data WHERE date >= DATE '{SPLIT}')"


def _test(spark, sf):
    d = D.demand_features(_ts(spark, sf))
    return D.naive_forecast(d.filter(F.col("date") >= F.lit(SPLIT).cast("date")))


@register("naive_forecast", f"{TEST_SQL} SELECT drug_id, date, target, round(naive, 6) AS naive FROM test")
def naive_forecast(spark, sf):
    """M6: next week = trailing 7-day mean x 7, on the test period."""
    return _round(_test(spark, sf).select("drug_id", "date", "target", "naive"), ["naive"])


@register("mae", f"{TEST_SQL} SELECT round(AVG(abs(target - naive)), 6) AS mae FROM test")
def mae(spark, sf):
    """Mean absolute error of the naive forecast."""
    return _round(M.mae(_test(spark, sf), "target", "naive"), ["mae"])


@register("mape", f"{TEST_SQL} SELECT round(AVG(abs(target - naive) / greatest(target, 1.0)) * 100, 6) AS mape FROM test")
def mape(spark, sf):
    """Mean absolute percentage error (denominator floored at 1)."""
    return _round(M.mape(_test(spark, sf), "target", "naive"), ["mape"])


@register("series_scale", f"{TS_SQL} SELECT drug_id, round(AVG(CASE WHEN date < DATE '{SPLIT}' THEN units END), 6) "
          "AS scale FROM ts GROUP BY drug_id")
def series_scale(spark, sf):
    """Per-drug mean over the training period."""
    return _round(D.series_scale(_ts(spark, sf), SPLIT), ["scale"])


DEMAND_WINDOWS_SQL = f"""{TS_SQL},
sc AS (SELECT drug_id, AVG(CASE WHEN date < DATE '{SPLIT}' THEN units END) AS scale FROM ts GROUP BY drug_id),
w AS (SELECT drug_id, date,
        LIST(units) OVER ({SW} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS win,
        SUM(units) OVER ({SW} ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS tgt,
        COUNT(units) OVER ({SW} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS n_after FROM ts)
SELECT w.drug_id, w.date, list_transform(w.win, lambda x: x / sc.scale) AS "window",
       w.tgt / sc.scale AS target, sc.scale, w.date < DATE '{SPLIT}' AS is_train
FROM w JOIN sc ON w.drug_id = sc.drug_id WHERE len(w.win) = 28 AND w.n_after = 7"""


@register("demand_windows", DEMAND_WINDOWS_SQL)
def demand_windows(spark, sf):
    """28-day windows and 7-day targets scaled per drug."""
    return D.demand_windows(_ts(spark, sf), SPLIT)


@register("calendar_slice", f"""{TS_SQL}
SELECT * FROM (SELECT drug_id, date, units, CAST(ROW_NUMBER() OVER ({SW}) - 1 AS INTEGER) AS row_idx FROM ts)
WHERE row_idx BETWEEN 28 AND 34""")
def calendar_slice(spark, sf):
    """Rows 28-34 of each drug's calendar."""
    from dosewise.operators.relational import slice_rows
    return slice_rows(_ts(spark, sf), ["drug_id"], ["date"], 28, 34)


REQ_SQL = f"""{TS_SQL},
req AS (SELECT drug_id, date AS as_of, LIST(units) OVER ({SW} ROWS BETWEEN 28 PRECEDING AND CURRENT ROW) AS d FROM ts),
ok AS (SELECT * FROM req WHERE len(d) = 29),
rf AS (SELECT drug_id, as_of, d[29] AS units, d[28] AS lag_1, d[22] AS lag_7, d[15] AS lag_14, d[1] AS lag_28,
              list_sum(d[22:28]) / 7.0 AS roll7, list_sum(d[1:28]) / 28.0 AS roll28,
              CAST(isodow(as_of) - 1 AS INTEGER) AS dow, CAST(month(as_of) AS INTEGER) AS month FROM ok)"""


def _requests(spark, sf):
    return D.request_features(D.history_requests(_ts(spark, sf)))


@register("request_features", f"{REQ_SQL} SELECT drug_id, as_of, units, lag_1, lag_7, lag_14, lag_28, "
          "round(roll7, 6) AS roll7, round(roll28, 6) AS roll28, dow, month FROM rf")
def request_features(spark, sf):
    """Forecast features computed from raw 29-value histories."""
    r = _requests(spark, sf).drop("daily_units")
    return _round(r, ["roll7", "roll28"])


UNKNOWN, SHORT = "unknown drug_id", "daily_units must hold 29 values"


@register("request_validation", f"""{TS_SQL},
req AS (SELECT drug_id, date AS as_of, LIST(units) OVER ({SW} ROWS BETWEEN 28 PRECEDING AND CURRENT ROW) AS d FROM ts),
bad AS (SELECT *, drug_id IN ({', '.join(f"'{x}'" for x in A.CONTROLLED_TYPES)}) AS unknown FROM req)
SELECT drug_id, as_of, CAST(len(d) AS INTEGER) AS n_values, NOT unknown AND len(d) = 29 AS accepted,
       concat_ws('; ', CASE WHEN unknown THEN '{UNKNOWN}' END, CASE WHEN len(d) <> 29 THEN '{SHORT}' END) AS reason FROM bad""")
def request_validation(spark, sf):
    """Demand requests for every drug and day.  The model serves the
    uncontrolled drugs, so requests for others are unknown; early days have
    short histories.  Accepted and rejected, with every reason."""
    from pyspark.sql import Window

    from dosewise.ml.scoring import validate
    ts = _ts(spark, sf)
    w = Window.partitionBy("drug_id").orderBy("date").rowsBetween(-28, 0)
    req = ts.select("drug_id", F.col("date").alias("as_of"), F.collect_list("units").over(w).alias("daily_units"))
    served = A.drugs(spark, sf).filter("drug_class = 0").select("drug_id", F.lit(True).alias("_served"))
    checked = validate(req.join(served, "drug_id", "left"),
                       {UNKNOWN: F.col("_served"), SHORT: F.size("daily_units") == 29})
    return checked.select("drug_id", "as_of", F.size("daily_units").alias("n_values"), "accepted", "reason")


@register("suggested_order", f"""{REQ_SQL}
SELECT drug_id, as_of, CAST(round_even(roll7 * 7, 0) AS BIGINT) AS forecast_next_7_days,
       CAST(round_even(roll7 * 7 * 1.1, 0) AS BIGINT) AS suggested_order FROM rf""")
def suggested_order(spark, sf):
    """Order quantity = forecast x 1.1, rounded half to even (the
    forecast here is the naive trailing-week model)."""
    from dosewise.ml.scoring import suggested_order as order
    r = _requests(spark, sf).withColumn("forecast", F.col("roll7") * F.lit(7.0))
    return order(r, "forecast").select("drug_id", "as_of", "forecast_next_7_days", "suggested_order")
