"""Queries: streaming jobs run to completion over the driver tables
(ST1-ST4, ST6, ST7).  Each streams the line-item (or events) file through
Structured Streaming with the availableNow trigger into a sink under the
shared checkpoint folder and returns the sink read back; the oracle is the
batch twin's SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewise.plans.q_courses import CENSOR_SQL, WITH_FILLS, WITH_HIST, _round
from dosewise.plans.registry import register
from dosewise.streaming import jobs as J


def _sink(spark, sdf, name, mode="append"):
    path = J.scratch(spark, name)
    J.run_available(sdf.writeStream.format("parquet").outputMode(mode).option("path", path + "/out"),
                    path + "/ckpt")
    return spark.read.parquet(path + "/out")


@register("stream_fills", f"{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty, "
          "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM fills")
def stream_fills(spark, sf):
    """ST1: pickups ingested as a stream, duplicates dropped within the
    watermark."""
    s = J.stream_fills(spark, sf)
    return _sink(spark, s, "fills").select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty",
                                           "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("stream_daily_units", """
SELECT CAST(ts AS DATE) AS date, event_type, round(SUM(value), 4) AS units, COUNT(*) AS n FROM events
GROUP BY 1, 2 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY""")
def stream_daily_units(spark, sf):
    """ST2: daily tumbling sums per event type; days closed by the watermark
    (max event time - 1 day) are emitted."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    s = J.read_stream(spark, f"{sf}/events.parquet", ev.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    out = _sink(spark, J.stream_daily_units(s, "ts", "event_type", "value", "1 day"), "daily")
    return out.withColumn("units", F.round("units", 4))


HISTORY_STREAM_SQL = f"""{WITH_HIST} SELECT patient_id, drug_id, fill_dt, l_orderkey, l_linenumber, fill_number,
prev_gap, was_late, round(avg_gap, 6) AS avg_gap, round(pct_late, 6) AS pct_late, false AS late_arrival FROM hist"""


@register("stream_history", HISTORY_STREAM_SQL)
def stream_history(spark, sf):
    """ST3: running course features from keyed state, one row per pickup."""
    s = J.stream_history(J.stream_fills(spark, sf))
    return _round(_sink(spark, s, "history"), ["avg_gap", "pct_late"])


@register("stream_history_batches", HISTORY_STREAM_SQL)
def stream_history_batches(spark, sf):
    """ST3 over four micro-batches in day order: state is carried."""
    path, files = _in_day_order(spark, sf)
    s = J.stream_history(J.stream_fills(spark, path, max_files=files))
    return _round(_sink(spark, s, "history"), ["avg_gap", "pct_late"])


LABEL_STREAM_SQL = f"""{WITH_HIST}
SELECT patient_id, drug_id, fill_dt, l_orderkey, l_linenumber, runout_dt, came_back,
       CASE WHEN next_fill_dt IS NOT NULL THEN 'next' ELSE 'timer' END AS resolved_by
FROM hist WHERE next_fill_dt IS NOT NULL OR {CENSOR_SQL.replace("<=", "<")}"""


@register("stream_labels", LABEL_STREAM_SQL)
def stream_labels(spark, sf):
    """ST7: labels resolved by the next pickup, or by an event-time timer once
    the watermark (latest pickup day - 1 day) passes run-out + 14 days."""
    s = J.stream_labels(J.stream_fills(spark, sf, delay="1 day"))
    return _sink(spark, s, "labels")


@register("stream_labels_batches", f"""{WITH_HIST}
SELECT patient_id, drug_id, fill_dt, l_orderkey, l_linenumber, runout_dt, came_back
FROM hist WHERE next_fill_dt IS NOT NULL OR {CENSOR_SQL.replace("<=", "<")}""")
def stream_labels_batches(spark, sf):
    """ST7 over four micro-batches in day order.  A timer can fire before a
    pickup that comes late arrives; both give the same label."""
    path, files = _in_day_order(spark, sf)
    s = J.stream_labels(J.stream_fills(spark, path, delay="1 day", max_files=files))
    return _sink(spark, s, "labels").drop("resolved_by")


FILE_ROWS = 1 << 20     # line items of one file, about


def _in_day_order(spark, sf, parts=4):
    """(path, files): the tables with the line items in ``parts`` parts in day
    order, each of so many files, which one micro-batch reads."""
    path = J.scratch(spark, "in-order")
    for t in ("orders", "part"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    q = li.agg(F.percentile_approx(day, [k / parts for k in range(1, parts)]).alias("q")).first()["q"]
    bounds = list(zip([None, *q], [*q, None]))

    def inside(lo, hi):
        return (F.lit(True) if lo is None else day >= lo) & (F.lit(True) if hi is None else day < hi)

    rows = li.agg(*[F.count(F.when(inside(*b), 1)).alias(f"n{i}") for i, b in enumerate(bounds)]).first()
    files = max(1, -(-max(rows) // FILE_ROWS))
    # every part needs its files: with a part too small to fill them, one each
    files = files if min(rows) >= files * 64 else 1
    for b in bounds:
        li.filter(inside(*b)).repartition(files).write.mode("append").parquet(f"{path}/lineitem.parquet")
    return path, files


def _train_test_files(spark, sf, parts=4, table=None):
    """(training rows, a folder of the test rows in files, their schema) of the
    training table, or of ``table`` where it is written already."""
    from dosewise.plans.q_models import _training
    from dosewise.sources.adapter import SPLIT_DATE
    t = _training(spark, sf) if table is None else table
    train = t.filter(F.col("runout_dt") < F.lit(SPLIT_DATE).cast("date"))
    path = J.scratch(spark, "requests")
    t.filter(F.col("runout_dt") >= F.lit(SPLIT_DATE).cast("date")).repartition(parts).write.parquet(path)
    return train, path, spark.read.parquet(path).schema


@register("stream_score")
def stream_score(spark, sf):
    """ST4: arriving refill requests validated and scored per micro-batch by
    the logistic baseline; rejects go to a side table."""
    return score_stream(spark, sf)


def score_stream(spark, sf, table=None):
    """ST4, over a training table that is written already if one is given."""
    from dosewise.ml.models import fit_logistic
    from dosewise.ml.scoring import refill_rules
    train, path, schema = _train_test_files(spark, sf, table=table)
    model = fit_logistic(train)
    out = J.scratch(spark, "scored")
    handle = J.stream_score(model, refill_rules(), out + "/ok", out + "/rejected")
    sdf = J.read_stream(spark, path, schema, max_files=1)
    J.run_available(sdf.writeStream.foreachBatch(handle), out + "/ckpt")
    return spark.read.parquet(out + "/ok").select("batch_id", "drug_name", "fill_number", "refill_probability",
                                                  "risk", "action", "came_back")


@register("stream_drift")
def stream_drift(spark, sf):
    """ST6: PSI of every micro-batch of live rows against the training cuts."""
    from dosewise.operators.drift import NUMERIC
    train, path, schema = _train_test_files(spark, sf)
    out = J.scratch(spark, "drift")
    handle = J.stream_drift(train, NUMERIC, out + "/psi")
    J.run_available(J.read_stream(spark, path, schema, max_files=1).writeStream.foreachBatch(handle), out + "/ckpt")
    return spark.read.parquet(out + "/psi")


def forecast_model(spark, sf):
    """The demand model (400/4/0.05) and the test period's request histories."""
    from dosewise.ml.models import fit_demand
    from dosewise.operators import demand as D
    from dosewise.plans.q_courses import _fills
    from dosewise.sources.adapter import SPLIT_DATE
    ts = D.daily_calendar(_fills(spark, sf))
    model = fit_demand(D.demand_features(ts).filter(F.col("date") < F.lit(SPLIT_DATE).cast("date")))
    return model, D.history_requests(ts).filter(F.col("as_of") >= F.lit(SPLIT_DATE).cast("date"))


def forecast_stream(spark, requests, model):
    path = J.scratch(spark, "histories")
    requests.repartition(4).write.parquet(path)
    out = J.scratch(spark, "forecasts")
    handle = J.stream_forecast(model, out + "/out")
    sdf = J.read_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    J.run_available(sdf.writeStream.foreachBatch(handle), out + "/ckpt")
    return spark.read.parquet(out + "/out").select("batch_id", "drug_id", "as_of", "forecast",
                                                   "forecast_next_7_days", "suggested_order")


@register("stream_forecast")
def stream_forecast(spark, sf):
    """ST5: raw 29-value histories arriving as files, forecast per
    micro-batch by the demand model (400/4/0.05) with order quantities."""
    model, req = forecast_model(spark, sf)
    return forecast_stream(spark, req, model)
