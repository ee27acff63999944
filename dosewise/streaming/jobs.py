"""Structured Streaming forms of the batch operators (ST1-ST7).

Each job reads a file source with an explicit schema, keeps bounded state
(watermarks purge it), writes to an exactly-once sink (Parquet file sink or
``foreachBatch`` with idempotent overwrite) and checkpoints to a folder under
the shared ``spark.checkpoint.dir``.  ``run_available`` drives a query over
everything available and stops, which is how the tests compare every stream
with its batch twin.

Stateful operators (engine state, ``transformWithState``):
* ST3 ``stream_history``: per course (patient, drug) the state is
  (pickups so far, last day, sum of gaps, late count); each pickup gets the
  same leak-free features as ``courses.course_history``.  Pickups that
  arrive older than the course's last day are processed in arrival order
  and marked ``late_arrival``.  Courses without a pickup for ``keep_days``
  leave the state.
* ST7 ``stream_labels``: per course the state is the pickup still waiting
  for its label.  The next pickup by day resolves it (came_back = next -
  run-out <= grace), also one that arrives late and lies before the waiting
  one; otherwise an event-time timer at run-out + grace fires once the
  watermark passes it and emits came_back = 0 - the streaming form of
  censoring.
A micro-batch's rows of one bucket are held at once, so the batch size
(``max_files``, or ``maxBytesPerTrigger`` of the source) bounds memory, also for
a course that has a third of all rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dosewise.session import ensure_checkpoint_dir, ship_package, stored
from dosewise.sources.adapter import LONG_SUPPLY_TYPES, TIE

DAY_MS = 86_400_000


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:8]}"


def run_available(writer, checkpoint: str, timeout_s: float | None = None,
                  state_partitions: int | None = None):
    """Start a ``DataStreamWriter`` with the availableNow trigger, wait until
    all available input is processed, stop.

    A stream fixes its number of state partitions when it first starts (it is
    kept in the checkpoint).  It is set to ``state_partitions`` (default: the
    cluster's default parallelism) for this query only; the session's
    setting is restored afterwards.  State is kept by the engine's RocksDB
    provider: on local disk, with its changes in the checkpoint folder."""
    spark = SparkSession.getActiveSession()
    n = state_partitions or spark.sparkContext.defaultParallelism
    ours = {"spark.sql.shuffle.partitions": str(n), "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            # a count of keys for the progress report looks every key up once more before it is written
            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
    old = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        done = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
        q.stop()
        if not done:
            raise TimeoutError(f"the stream had not read all its input after {timeout_s} s; its output is not complete")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return q


# --- sources --------------------------------------------------------------------------

def stream_path(path: str) -> str:
    """The file stream source watches a folder; a single local file (the
    test tables) is watched through a one-file glob."""
    if os.path.isfile(path):
        return path[:-1] + f"[{path[-1]}]"
    return path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(stream_path(path))


def stream_fills(spark: SparkSession, sf_dir: str, item: str = "p_type", delay: str = "30 days",
                 max_files: int | None = None) -> DataFrame:
    """ST1: pickups arriving as line-item files, joined to the static order and
    part tables (stream-static joins), with an event-time watermark on the
    pickup day and duplicate line items dropped within the watermark."""
    li_schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    li = read_stream(spark, f"{sf_dir}/lineitem.parquet", li_schema, max_files=max_files)
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_id"))
    pt = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("l_partkey"), F.col(item).alias("drug_id"), "p_type")
    # event time = UTC midnight of the pickup day, independent of the session time zone
    s = li.withColumn("event_ts", F.timestamp_seconds(F.unix_date(F.col("l_shipdate").cast("date")) * 86400))
    s = s.withWatermark("event_ts", delay)
    s = s.dropDuplicatesWithinWatermark(TIE)   # the full tie key is the unique line id
    s = s.join(od, "l_orderkey").join(pt, "l_partkey")
    return s.select(
        "patient_id", "drug_id", F.col("l_shipdate").cast("date").alias("fill_dt"), "event_ts",
        F.when(F.col("p_type").isin(LONG_SUPPLY_TYPES), F.lit(90)).otherwise(F.lit(30)).alias("supply_days"),
        F.col("l_quantity").alias("disp_qty"), *TIE)


def stream_daily_units(sdf: DataFrame, ts: str, key: str, value: str, delay: str = "1 day") -> DataFrame:
    """ST2: tumbling daily sums per key; a day is emitted once the watermark
    (max event time - delay) has passed its end, and its state is dropped."""
    return (sdf.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"), key)
            .agg(F.sum(value).alias("units"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("date").alias("date"), key, "units", "n"))


# --- ST3, ST7: courses in buckets of keyed state ------------------------------------------
#
# A course is one patient on one drug.  Courses are dealt into a fixed number of
# buckets by a hash; a bucket is the key of the stateful operator.  Its state is
# one Arrow table with a row per live course, so a micro-batch costs one call and
# one read and write of state per bucket, whatever the number of courses, and the
# work inside a call is vectorised.  A bucket has one event-time timer, at the
# first moment at which one of its courses is due.

BUCKETS = 256
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COURSE = ["patient_id", "drug_id"]
_NUMBERS = [c for c in TIE if c != "l_shipdate"]
_SORT = [*_COURSE, "day", *["ship" if c == "l_shipdate" else c for c in TIE]]


def bucketed(sdf: DataFrame, buckets: int):
    """The rows as numbers, grouped by bucket.  Rows without a patient, an item or
    a day belong to no course and are left out."""
    rows = sdf.where("patient_id is not null and drug_id is not null and fill_dt is not null").select(
        F.pmod(F.xxhash64(*_COURSE), F.lit(buckets)).cast("int").alias("bucket"), *_COURSE, "event_ts",
        F.unix_date("fill_dt").cast("long").alias("day"), F.col("supply_days").cast("long").alias("supply"), *_NUMBERS,
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship"))
    return rows.groupBy("bucket")


class CourseBucket(StatefulProcessor):
    """State of a bucket: a table of its live courses, and its timer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("courses", "courses binary, timer long")

    def load(self) -> tuple[pd.DataFrame | None, int]:
        got = self.value.get() if self.value.exists() else None
        return (pa.ipc.open_stream(got[0]).read_pandas(), got[1]) if got else (None, -1)

    def store(self, courses: pd.DataFrame, due: np.ndarray, timer: int) -> None:
        """Keep the courses; wake at the first due time (milliseconds)."""
        at = int(due.min()) if len(due) else -1
        if timer != at:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if at >= 0:
                self.handle.registerTimer(at)
        if len(courses):
            table = pa.Table.from_pandas(courses, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            self.value.update((sink.getvalue().to_pybytes(), at))
        else:
            self.value.clear()

    def arrived(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """A bucket's new rows, in order within each course."""
        return pd.concat(list(rows), ignore_index=True).sort_values(_SORT, ignore_index=True)

    def close(self) -> None:
        pass


def _heads(pdf: pd.DataFrame) -> np.ndarray:
    """Whether a row is the first of its course (the rows are sorted)."""
    p, d = (pdf[c].to_numpy() for c in _COURSE)
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (d[1:] != d[:-1])
    return new


HISTORY_OUT = ("patient_id long, drug_id string, day long, l_orderkey long, l_linenumber int, fill_number int, "
               "prev_gap double, was_late int, avg_gap double, pct_late double, late_arrival boolean")


class CourseHistory(CourseBucket):
    """ST3.  A course's row: pickups so far, latest day, sum of gaps, late ones."""

    def __init__(self, grace: int, keep_days: int):
        self.grace, self.keep = grace, keep_days

    def live(self, courses: pd.DataFrame, now_ms: int) -> tuple[pd.DataFrame, np.ndarray]:
        """Courses that are not over yet, and when they will be."""
        due = (courses["last"].to_numpy() + self.keep) * DAY_MS
        return courses[due > now_ms], due[due > now_ms]

    def handleInputRows(self, key, rows, timerValues):
        old, timer = self.load()
        pdf = self.arrived(rows)
        new = _heads(pdf)
        first = np.flatnonzero(new)
        course = np.cumsum(new) - 1
        heads = pdf.loc[first, _COURSE]
        empty = pd.DataFrame({**{c: heads[c][:0] for c in _COURSE}, "n": np.zeros(0, "int64"), "last": np.zeros(0, "int64"),
                              "gaps": np.zeros(0), "lates": np.zeros(0, "int64")})
        now_ms = timerValues.getCurrentWatermarkInMs()
        old = empty if old is None else self.live(old, now_ms)[0]
        was = heads.merge(old, on=_COURSE, how="left")
        known = was["n"].notna().to_numpy()
        n0, gaps0, lates0 = (was[c].fillna(0).to_numpy() for c in ("n", "gaps", "lates"))
        last0 = was["last"].to_numpy(dtype=float)
        day = pdf["day"].to_numpy(dtype=float)
        before = np.empty(len(day))
        before[1:] = day[:-1]
        before[first] = last0                                       # none yet: NaN
        before = np.fmax(before, np.where(known, last0, -np.inf)[course])   # a late row comes after the latest day
        before[~np.isfinite(before)] = np.nan
        gap = np.where(np.isnan(before), pdf["supply"], day - before)
        late = (gap > pdf["supply"].to_numpy() + self.grace).astype("int32")
        size = np.diff(np.append(first, len(day)))

        def running(x):
            total = np.cumsum(x)
            return total - np.repeat(total[first] - x[first], size)

        k = running(np.ones(len(day))) + n0[course]
        gaps, lates = running(gap) + gaps0[course], running(late.astype(float)) + lates0[course]
        tail = first + size - 1
        now = heads.assign(n=k[tail].astype("int64"), last=np.fmax(day[tail], last0).astype("int64"), gaps=gaps[tail],
                           lates=lates[tail].astype("int64"))
        rest = old.merge(heads, on=_COURSE, how="left", indicator=True)
        rest = old[(rest["_merge"] == "left_only").to_numpy()]
        courses = pd.concat([rest, now], ignore_index=True) if len(rest) else now
        self.store(*self.live(courses, now_ms), timer)
        yield pd.DataFrame({
            **{c: pdf[c] for c in ("patient_id", "drug_id", "day", "l_orderkey", "l_linenumber")}, "fill_number": k.astype("int32"),
            "prev_gap": gap, "was_late": late, "avg_gap": gaps / k, "pct_late": lates / k,
            "late_arrival": ~np.isnan(before) & (day < before)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        courses, _ = self.load()
        if courses is not None:
            self.store(*self.live(courses, timerValues.getCurrentWatermarkInMs()), -1)
        return iter([])


def stream_history(sdf: DataFrame, grace: int = 14, buckets: int = BUCKETS, keep_days: int = 3650) -> DataFrame:
    """ST3: leak-free course features per arriving pickup.  A course without a
    pickup for ``keep_days`` before the watermark is over: its state goes, and a
    later pickup starts a new one."""
    ship_package(sdf.sparkSession)
    out = bucketed(sdf, buckets).transformWithStateInPandas(CourseHistory(grace, keep_days), HISTORY_OUT, "append", "EventTime")
    return out.select("patient_id", "drug_id", F.date_from_unix_date(F.col("day").cast("int")).alias("fill_dt"), "l_orderkey",
                      "l_linenumber", "fill_number", "prev_gap", "was_late", "avg_gap", "pct_late", "late_arrival")


LABEL_OUT = ("patient_id long, drug_id string, day long, supply long, l_orderkey long, l_linenumber int, came_back int, "
             "resolved_by string")


class CourseLabels(CourseBucket):
    """ST7.  A course's row: the pickup that waits for its label."""

    def __init__(self, grace: int):
        self.grace = grace

    def due(self, waiting: pd.DataFrame) -> np.ndarray:
        """The watermark that passes run-out + grace answers a pickup."""
        return ((waiting["day"] + waiting["supply"] + self.grace) * DAY_MS).to_numpy()

    def answered(self, pdf: pd.DataFrame, came, how: str) -> pd.DataFrame:
        return pdf[["patient_id", "drug_id", "day", "supply", "l_orderkey", "l_linenumber"]].assign(came_back=came, resolved_by=how)

    def handleInputRows(self, key, rows, timerValues):
        waiting, timer = self.load()
        pdf = self.arrived(rows).drop(columns=["bucket", "event_ts"])
        if waiting is not None:       # a late pickup can come before the waiting one
            pdf = pd.concat([waiting, pdf], ignore_index=True).sort_values(_SORT, ignore_index=True)
        last = np.append(_heads(pdf)[1:], True)
        day, supply = pdf["day"].to_numpy(), pdf["supply"].to_numpy()
        came = np.zeros(len(pdf), "int32")
        came[:-1] = day[1:] - (day[:-1] + supply[:-1]) <= self.grace
        left = pdf[last]
        self.store(left, self.due(left) - 1, timer)
        if not last.all():
            yield self.answered(pdf[~last], came[~last], "next")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        waiting, _ = self.load()
        if waiting is None:
            return
        due = self.due(waiting)
        over = due <= timerValues.getCurrentWatermarkInMs()
        self.store(waiting[~over], due[~over] - 1, -1)
        if over.any():
            yield self.answered(waiting[over], np.zeros(over.sum(), "int32"), "timer")


def stream_labels(sdf: DataFrame, grace: int = 14, buckets: int = BUCKETS) -> DataFrame:
    """ST7: came_back for every pickup as soon as it is known."""
    ship_package(sdf.sparkSession)
    out = bucketed(sdf, buckets).transformWithStateInPandas(CourseLabels(grace), LABEL_OUT, "append", "EventTime")
    day = F.col("day").cast("int")
    return out.select("patient_id", "drug_id", F.date_from_unix_date(day).alias("fill_dt"), "l_orderkey", "l_linenumber",
                      F.date_from_unix_date(day + F.col("supply").cast("int")).alias("runout_dt"), "came_back", "resolved_by")


# --- ST4-ST6: micro-batch scoring and monitoring ---------------------------------------------

def stream_score(model, rules: dict, accepted_path: str, rejected_path: str) -> Callable:
    """ST4: foreachBatch function validating requests, scoring accepted ones
    with a fitted pipeline and appending rejects (with reasons) to a side
    table.  Writes are keyed by batch id so a replayed batch overwrites its
    own partition (idempotent)."""
    from pyspark.ml.functions import vector_to_array

    from dosewise.ml.scoring import risk_bands, validate

    def handle(batch: DataFrame, batch_id: int):
        v = validate(batch, rules).withColumn("batch_id", F.lit(batch_id))
        ok = v.filter("accepted").drop("reason", "accepted")
        scored = risk_bands(model.transform(ok).withColumn("probability", vector_to_array("probability")[1]))
        scored = scored.drop("features", "rawPrediction", "prediction", "drug_name_idx", "drug_name_vec")
        (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(accepted_path))
        (v.filter(~F.col("accepted")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(rejected_path))
    return handle


def stream_forecast(model, out_path: str) -> Callable:
    """ST5: foreachBatch function turning raw 29-value histories into
    forecasts and order quantities (V4/V5)."""
    from dosewise.ml.scoring import score_demand

    def handle(batch: DataFrame, batch_id: int):
        out = score_demand(batch, model).withColumn("batch_id", F.lit(batch_id))
        (out.drop("features", "drug_id_idx", "drug_id_vec").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))
    return handle


def stream_drift(base: DataFrame, cols: list[str], out_path: str, bins: int = 10) -> Callable:
    """ST6: foreachBatch function scoring each micro-batch's PSI against the
    baseline's cut points (computed once, kept as a small written table)."""
    from dosewise.operators import drift as DR
    cuts = stored(DR.psi_cuts(base, cols, bins), "cuts")
    e = stored(DR.bucket_shares(base, cols, cuts).withColumnRenamed("share", "e"), "shares")

    def handle(batch: DataFrame, batch_id: int):
        a = DR.bucket_shares(batch, cols, cuts).withColumnRenamed("share", "a")
        p = (e.join(a, ["feature", "bucket"])
             .groupBy("feature").agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi")))
        out = cuts.select("feature").join(p, "feature", "left").select(
            F.lit(batch_id).alias("batch_id"), "feature", F.coalesce("psi", F.lit(0.0)).alias("psi"),
            F.lit(batch.count()).alias("n_rows"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))
    return handle
