"""Daily demand series and forecast features.

Facts are summed to (item, day) first (partial aggregation), so every window
below runs on the small dense calendar, never on raw pickups.  The calendar
is generated per item with ``explode(sequence(first, last))`` between the
global first and last day (two scalar subqueries); quiet days are filled
with 0 by an equi join on (item, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.functions.scalars import dow, month
from dosewise.session import stored

LAGS = [1, 7, 14, 28]
ROLLS = [7, 28]


def daily_units(df: DataFrame, key: str = "drug_id", date: str = "fill_dt",
                value: str = "disp_qty") -> DataFrame:
    """A1: units per (item, day)."""
    return df.groupBy(key, date).agg(F.sum(value).alias("units"))


def daily_calendar(df: DataFrame, key: str = "drug_id", date: str = "fill_dt",
                   value: str = "disp_qty") -> DataFrame:
    """One row per item and calendar day from the data's first to last
    day, units 0 on quiet days.  Columns: key, date, units.  The facts are read
    once: the daily sums are written, and all else is made of them."""
    daily = stored(daily_units(df, key, date, value).withColumnRenamed(date, "date"), "daily")
    first = daily.agg(F.min("date")).scalar()
    last = daily.agg(F.max("date")).scalar()
    items = daily.select(key).distinct()
    cal = items.select(key, F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    return (cal.join(daily, [key, "date"], "left")
            .select(key, "date", F.coalesce(F.col("units"), F.lit(0.0)).alias("units")))


def _series_window(key: str):
    return Window.partitionBy(key).orderBy("date")


def with_lags(ts: DataFrame, col: str = "units", lags=LAGS, key: str = "drug_id") -> DataFrame:
    """Value k rows earlier on the dense calendar (k days)."""
    w = _series_window(key)
    return ts.select("*", *[F.lag(col, k).over(w).alias(f"lag_{k}") for k in lags])


def _full_mean(col: str, w, k: int):
    f = w.rowsBetween(-k, -1)
    return F.when(F.count(col).over(f) == k, F.avg(col).over(f))


def with_rolling(ts: DataFrame, col: str = "units", sizes=ROLLS, key: str = "drug_id") -> DataFrame:
    """Trailing mean of the k previous days (today excluded), NULL until
    k days exist."""
    w = _series_window(key)
    return ts.select("*", *[_full_mean(col, w, k).alias(f"roll{k}") for k in sizes])


def forward_sum(ts: DataFrame, col: str = "units", horizon: int = 7, key: str = "drug_id",
                out: str = "target") -> DataFrame:
    """Sum of the next ``horizon`` days (today excluded), NULL until all
    exist."""
    f = _series_window(key).rowsBetween(1, horizon)
    return ts.withColumn(out, F.when(F.count(col).over(f) == horizon, F.sum(col).over(f)))


def demand_features(ts: DataFrame, key: str = "drug_id", lags=LAGS, rolls=ROLLS,
                    horizon: int = 7, dropna: bool = True) -> DataFrame:
    """Lags, trailing means, weekday, month and the 7-day forward target,
    all in one window pass over (item ordered by day); incomplete rows dropped."""
    w = _series_window(key)
    fwd = w.rowsBetween(1, horizon)
    d = ts.select(
        "*",
        *[F.lag("units", k).over(w).alias(f"lag_{k}") for k in lags],
        *[_full_mean("units", w, k).alias(f"roll{k}") for k in rolls],
        dow("date").alias("dow"), month("date").alias("month"),
        F.when(F.count("units").over(fwd) == horizon, F.sum("units").over(fwd)).alias("target"),
    )
    return d.dropna("any") if dropna else d


def naive_forecast(df: DataFrame) -> DataFrame:
    """M6: next week = last week (trailing 7-day mean x 7)."""
    return df.withColumn("naive", F.col("roll7") * F.lit(7.0))


def series_scale(ts: DataFrame, split: str, key: str = "drug_id") -> DataFrame:
    """Per-series mean over the training period only."""
    return ts.groupBy(key).agg(
        F.avg(F.when(F.col("date") < F.lit(split).cast("date"), F.col("units"))).alias("scale"))


def demand_windows(ts: DataFrame, split: str, look_back: int = 28, horizon: int = 7,
                   key: str = "drug_id") -> DataFrame:
    """For every day t with a full look-back and horizon, the 28
    values t-28..t-1 and the target = sum of t..t+6, both divided by the
    series' training-period mean.  Rows are marked train (t < split) or test.

    Like the reference, the last window with a full horizon is not emitted
    (t runs to len - horizon - 1).
    """
    w = _series_window(key)
    back = w.rowsBetween(-look_back, -1)
    fwd = w.rowsBetween(0, horizon - 1)
    after = w.rowsBetween(1, horizon)
    scale = series_scale(ts, split, key)
    d = ts.select(
        key, "date",
        F.collect_list("units").over(back).alias("_win"),
        F.sum("units").over(fwd).alias("_tgt"),
        F.count("units").over(after).alias("_after"),
    )
    d = d.filter((F.size("_win") == look_back) & (F.col("_after") == horizon))
    # a series without demand before the split keeps its units
    scale = scale.withColumn("scale", F.when(F.col("scale") != 0, F.col("scale")).otherwise(F.lit(1.0)))
    d = d.join(scale, key)
    return d.select(
        key, "date",
        F.transform("_win", lambda x: x / F.col("scale")).alias("window"),
        (F.col("_tgt") / F.col("scale")).alias("target"),
        "scale",
        (F.col("date") < F.lit(split).cast("date")).alias("is_train"),
    )


def request_features(df: DataFrame, hist: str = "daily_units", as_of: str = "as_of") -> DataFrame:
    """The D9 features from a raw 29-value history (oldest first, last =
    today)."""
    d = F.col(hist)

    def mean_of(start, n):
        s = F.slice(d, start, n)
        return F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.lit(float(n))

    return df.select(
        "*",
        F.element_at(d, -1).alias("units"),
        F.element_at(d, -2).alias("lag_1"),
        F.element_at(d, -8).alias("lag_7"),
        F.element_at(d, -15).alias("lag_14"),
        F.element_at(d, -29).alias("lag_28"),
        mean_of(-8, 7).alias("roll7"),
        mean_of(-29, 28).alias("roll28"),
        dow(as_of).alias("dow"),
        month(as_of).alias("month"),
    )


def history_requests(ts: DataFrame, key: str = "drug_id", n: int = 29) -> DataFrame:
    """Build forecast requests from the calendar: for every day with 28 days
    of history, the last 29 daily values (oldest first) and the day."""
    w = _series_window(key).rowsBetween(-(n - 1), 0)
    d = ts.select(key, F.col("date").alias("as_of"), F.collect_list("units").over(w).alias("daily_units"))
    return d.filter(F.size("daily_units") == n)
