"""Streams over several micro-batches: pickups arrive as 4 files in day
order; keyed state must give
the batch features and the same labels."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from dosewise.streaming import jobs as J


@pytest.fixture(scope="module")
def chunked_dir(spark):
    d = tempfile.mkdtemp(prefix="dosewise-chunks-", dir="/tmp")
    for t in ["orders", "part"]:
        os.symlink(f"{SF0001}/{t}.parquet", f"{d}/{t}.parquet")
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    bounds = li.agg(F.percentile_approx("l_shipdate", [0.25, 0.5, 0.75]).alias("q")).first()["q"]
    edges = [None, *bounds, None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = li
        if lo is not None:
            part = part.filter(F.col("l_shipdate") >= F.lit(lo))
        if hi is not None:
            part = part.filter(F.col("l_shipdate") < F.lit(hi))
        part.coalesce(1).write.mode("append").parquet(f"{d}/lineitem.parquet")
    return d


@pytest.fixture(params=["50", "10000"])
def frame_rows(request, spark):
    """Rows per Arrow frame: few, so that a key's rows arrive in many frames."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_history_over_batches(spark, chunked_dir, frame_rows):
    from dosewise.plans.q_courses import refill_features
    cols = ["patient_id", "fill_dt", "l_orderkey", "l_linenumber", "fill_number", "prev_gap", "was_late",
            "avg_gap", "pct_late"]
    b = refill_features(spark, SF0001).select(*cols)
    for source in (chunked_dir, SF0001):
        k = J.stream_history(J.stream_fills(spark, source, max_files=1))
        kp = J.scratch(spark, "t-hist-k")
        J.run_available(k.writeStream.format("parquet").option("path", kp + "/out"), kp + "/ckpt")
        ko = spark.read.parquet(kp + "/out").select(
            *[F.round(c, 6).alias(c) if c in ("avg_gap", "pct_late") else c for c in cols])
        assert ko.exceptAll(b).count() == 0 and b.exceptAll(ko).count() == 0


def test_labels_over_batches(spark, chunked_dir, frame_rows):
    from dosewise.operators.courses import last_day
    from dosewise.plans.q_courses import label
    cols = ["patient_id", "drug_id", "fill_dt", "l_orderkey", "l_linenumber", "runout_dt", "came_back"]
    b = label(spark, SF0001)
    b = b.filter(F.col("next_fill_dt").isNotNull() | (F.date_add("runout_dt", 14) < last_day(b))).select(*cols)
    for source in (chunked_dir, SF0001):
        kp = J.scratch(spark, "t-lab-k")
        k = J.stream_labels(J.stream_fills(spark, source, delay="1 day", max_files=1))
        J.run_available(k.writeStream.format("parquet").option("path", kp + "/out"), kp + "/ckpt")
        ko = spark.read.parquet(kp + "/out").select(*cols)
        assert ko.exceptAll(b).count() == 0 and b.exceptAll(ko).count() == 0


def test_a_stream_that_is_not_done_raises(spark, chunked_dir):
    sdf = J.stream_history(J.stream_fills(spark, chunked_dir, max_files=1))
    kp = J.scratch(spark, "t-late")
    with pytest.raises(TimeoutError):
        J.run_available(sdf.writeStream.format("parquet").option("path", kp + "/out"), kp + "/ckpt", timeout_s=0.01)


def _arrivals(spark, batches, delay):
    """A stream of one file per batch of (patient, day number, key) pickups."""
    path = J.scratch(spark, "t-arrivals")
    for rows in batches:
        df = spark.createDataFrame([(p, "d", d, 30, k, 1, 1, 1, 1.0) for p, d, k in rows],
                                   "patient_id long, drug_id string, day int, supply_days int, l_orderkey long, l_linenumber int, "
                                   "l_partkey long, l_suppkey long, l_extendedprice double")
        df = df.withColumn("fill_dt", F.date_from_unix_date("day")).withColumn("l_shipdate", F.col("fill_dt").cast("timestamp"))
        df.withColumn("event_ts", F.timestamp_seconds(F.col("day").cast("long") * 86400)).coalesce(1).write.mode("append").parquet(path)
    sdf = J.read_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    return sdf.withWatermark("event_ts", delay)


def _ran(spark, sdf):
    path = J.scratch(spark, "t-out")
    J.run_available(sdf.writeStream.format("parquet").option("path", path + "/out"), path + "/ckpt")
    return spark.read.parquet(path + "/out")


def test_a_late_pickup_is_judged_by_the_pickup_after_it(spark):
    # day 100 waits; day 40 arrives late: its next pickup is day 100 (too late), and day 100 still waits
    sdf = _arrivals(spark, [[(1, 100, 1)], [(1, 40, 2)], [(1, 120, 3)], [(2, 300, 4)]], "90 days")
    got = {r.l_orderkey: (r.came_back, r.resolved_by) for r in _ran(spark, J.stream_labels(sdf)).collect()}
    assert got == {2: (0, "next"), 1: (1, "next"), 3: (0, "timer")}


def test_courses_that_are_over_leave_the_state(spark):
    batches = [[(1, 100, 1), (2, 100, 2)], [(1, 150, 3)], [(3, 400, 4)], [(2, 401, 5), (1, 402, 6)]]
    for keep, numbers in ((1000, {1: 1, 2: 1, 3: 2, 4: 1, 5: 2, 6: 3}), (200, {1: 1, 2: 1, 3: 2, 4: 1, 5: 1, 6: 1})):
        sdf = _arrivals(spark, batches, "1 day")
        out = _ran(spark, J.stream_history(sdf, keep_days=keep, buckets=2))
        assert {r.l_orderkey: r.fill_number for r in out.collect()} == numbers


def test_late_history_rows_and_rows_without_a_course(spark):
    sdf = _arrivals(spark, [[(1, 100, 1), (None, 100, 9)], [(1, 90, 2)], [(1, 130, 3)]], "90 days")
    got = {r.l_orderkey: (r.fill_number, r.prev_gap, r.late_arrival) for r in _ran(spark, J.stream_history(sdf)).collect()}
    assert got == {1: (1, 30.0, False), 2: (2, -10.0, True), 3: (3, 30.0, False)}


def test_stream_and_batch_scores_share_one_training_table(spark, monkeypatch):
    """Before, the check made the training table twice."""
    import datetime as dt
    import random

    from dosewise.plans import q_checks as QC
    from dosewise.plans import q_courses, q_models
    r = random.Random(4)
    rows = [(r.randint(20, 90), r.choice("abc"), r.random() < 0.5, r.choice([30, 90]), r.randint(1, 9), float(r.randint(20, 120)),
             r.randint(0, 1), float(r.randint(30, 90)), r.random(), dt.date(2000, 6, 1) + dt.timedelta(r.randint(0, 400)), r.randint(0, 1))
            for _ in range(300)]
    table = spark.createDataFrame(rows, "patient_age int, drug_name string, is_branded boolean, supply_days int, fill_number int, "
                                  "prev_gap double, was_late int, avg_gap double, pct_late double, runout_dt date, came_back int")
    made = []
    for module in (q_courses, q_models):
        monkeypatch.setattr(module, "training_table", lambda spark, sf: made.append(sf) or table)
    assert tuple(QC.stream_score_check(spark, "nowhere").first()) == (True, True)
    assert made == ["nowhere"]
