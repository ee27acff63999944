"""Queries with SQL for operators that other keys use on fitted scores only
(A19, A21, D17, E9, F18, O1, O4, O6, O7, O9, P13, S7, S8, U5): the same library
functions on columns of the given tables, so that every value has an oracle.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dosewise.functions.scalars import row_mse
from dosewise.ml import attribution as AT
from dosewise.ml import models as MD
from dosewise.ml import prep as P
from dosewise.operators import relational as R
from dosewise.operators.stats import global_index
from dosewise.plans import q_demand as QD
from dosewise.plans.q_courses import ORDER_SQL, ROW_ID, WITH_FILLS, _fills, _round, training_table
from dosewise.plans.q_quality import TT_SQL
from dosewise.plans.registry import register
from dosewise.session import ensure_checkpoint_dir
from dosewise.sources import adapter as A
from dosewise.sources import tables as S

IDS = ", ".join(ROW_ID)


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- ordering, samples, columns -------------------------------------------------------

_SORT = ["supply_days", "disp_qty", "patient_id", "drug_id", *A.ORDER]


@register("sorted_fills", f"""{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty, {IDS},
ROW_NUMBER() OVER (ORDER BY supply_days DESC, disp_qty, patient_id, drug_id, {ORDER_SQL}) - 1 AS row_idx FROM fills""")
def sorted_fills(spark, sf):
    """O1: every pickup with its place in a many-key order, the first key
    descending (range-partitioned sort, no task holds all rows)."""
    f = _fills(spark, sf)
    order = [F.col("supply_days").desc(), *[F.col(c).asc() for c in _SORT[1:]]]
    return global_index(f, order).select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty", *ROW_ID, "row_idx")


@register("drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders")
def drop_columns(spark, sf):
    """Drop columns (pruned at the scan); a name that is not there is ignored."""
    t = A.table(spark, sf, "orders")
    keep = {"o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"}
    return R.without(t, [c for c in t.columns if c not in keep] + ["no_such_column"])


_HASH = "md5(concat_ws('|', '{seed}', {key}))"


@register("sample_fills", f"""{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, {IDS} FROM fills
ORDER BY {_HASH.format(seed=42, key=IDS)}, {IDS} LIMIT 500""")
def sample_fills(spark, sf):
    """500 pickups, seeded: the least hashes of the line key."""
    return R.sample_n(_fills(spark, sf).select("patient_id", "drug_id", "fill_dt", *ROW_ID), ROW_ID, 500)


@register("sample_per_drug", f"""{WITH_FILLS} SELECT drug_id, patient_id, {IDS} FROM fills
QUALIFY ROW_NUMBER() OVER (PARTITION BY drug_id ORDER BY {_HASH.format(seed=7, key=IDS)}, {IDS}) <= 20""")
def sample_per_drug(spark, sf):
    """20 pickups of every drug, seeded; each task sends 20 of a drug at most."""
    return R.sample_n(_fills(spark, sf).select("drug_id", "patient_id", *ROW_ID), ROW_ID, 20, seed=7, by=["drug_id"])


@register("top_and_bottom", """SELECT 'most' AS side, * FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 6)
UNION ALL SELECT 'least', * FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 8)""")
def top_and_bottom(spark, sf):
    """The 6 largest and the 8 least by a score, ties by key."""
    t = A.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return (R.top(t, "o_totalprice", 6, ["o_orderkey"]).select(F.lit("most").alias("side"), "*")
            .unionByName(R.top(t, "o_totalprice", 8, ["o_orderkey"], asc=True).select(F.lit("least").alias("side"), "*")))


@register("ordered_queue", "SELECT true AS every_row, true AS each_part_sorted, true AS parts_in_order")
def ordered_queue(spark, sf):
    """Orders written as a work queue, dearest first, and read back: no part
    file overlaps the next in the order of their names."""
    t = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = _scratch(spark, "queue")
    S.write_ordered(t, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], path)
    place = F.struct(-F.col("o_totalprice"), F.col("o_orderkey"))
    q = spark.read.schema(t.schema).parquet(path).select(F.input_file_name().alias("part"), place.alias("at"),
                                                         F.monotonically_increasing_id().alias("i"))
    # rows of a part in file order: its places rise with the row number
    from pyspark.sql import Window
    inside = Window.partitionBy("part").orderBy("i")
    steps = q.withColumn("before", F.lag("at").over(inside))
    parts = steps.groupBy("part").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count(F.lit(1)).alias("n"),
                                      F.coalesce(F.bool_and(F.col("before") <= F.col("at")), F.lit(True)).alias("sorted"))
    listed = F.array_sort(F.collect_list(F.struct("part", "low", "high", "n", "sorted")))    # one row per file
    one = parts.agg(listed.alias("p"))
    return one.select(
        (F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["n"]) == t.agg(F.count(F.lit(1))).scalar()).alias("every_row"),
        F.forall("p", lambda x: x["sorted"]).alias("each_part_sorted"),
        F.forall(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p")).alias("b")),
                 lambda x: x["a"]["high"] < x["b"]["low"]).alias("parts_in_order"))


# --- layout -------------------------------------------------------------------------------

_SINCE, _UNTIL = "1997-03-10", "1997-09-05"


@register("pruned_scan", f"""{WITH_FILLS} SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty, {IDS} FROM fills
WHERE fill_dt >= DATE '{_SINCE}' AND fill_dt < DATE '{_UNTIL}' AND patient_id < 100""")
def pruned_scan(spark, sf):
    """Pickups laid out by month and patient, then a range of days and
    patients read back from the folders of those months only."""
    f = _fills(spark, sf).select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty", *ROW_ID)
    path = _scratch(spark, "by-month")
    S.write_pruned(f, path, "fill_dt", "patient_id")
    return S.read_pruned(spark, path, f.schema, "fill_dt", _SINCE, _UNTIL).where("patient_id < 100")


@register("changed_rows", f"""WITH a AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderpriority
      FROM orders WHERE o_orderkey % 89 <> 0 UNION ALL SELECT * FROM a WHERE o_orderkey % 83 = 0)
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def changed_rows(spark, sf):
    """Orders against a copy with rows changed, left out and repeated."""
    a = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    k = F.col("o_orderkey")
    b = a.where(k % 89 != 0).withColumn("o_custkey", F.when(k % 97 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return R.table_diff(a, b.unionAll(a.where(k % 83 == 0)))


# --- summaries of scores, groups and contributions -----------------------------------------------

@register("payer_summary", """SELECT c_mktsegment AS payer, COUNT(*) AS patients, round_even(AVG(c_acctbal), 2) AS c_acctbal,
round_even(AVG(c_nationkey), 2) AS c_nationkey FROM customer GROUP BY 1""")
def payer_summary(spark, sf):
    """Size and rounded means per group, as for segments."""
    c = A.table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "payer")
    return MD.cluster_summary(c, "payer", ["c_acctbal", "c_nationkey"])


_SAMPLE_SIZE = 2000


@register("silhouette", f"""WITH s AS (SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) / 1000 AS x, CAST(c_nationkey AS DOUBLE) AS y
  FROM customer ORDER BY {_HASH.format(seed=42, key='c_custkey')}, c_custkey LIMIT {_SAMPLE_SIZE}),
d AS (SELECT a.c_custkey, a.c_mktsegment, b.c_mktsegment AS to_label, SUM(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS total,
             COUNT(*) AS n FROM s a, s b GROUP BY 1, 2, 3),
m AS (SELECT c_custkey, c_mktsegment,
             MAX(CASE WHEN c_mktsegment = to_label THEN total / greatest(n - 1, 1) END) AS own,
             MAX(CASE WHEN c_mktsegment = to_label THEN n END) AS size,
             MIN(CASE WHEN c_mktsegment <> to_label THEN total / n END) AS other FROM d GROUP BY 1, 2)
SELECT c_custkey, c_mktsegment, round(own, 6) AS own, round(other, 6) AS other,
       round(CASE WHEN other IS NULL THEN NULL WHEN size = 1 OR greatest(own, other) = 0 THEN 0
                  ELSE (other - own) / greatest(own, other) END, 6) AS silhouette FROM m""")
def silhouette(spark, sf):
    """Euclidean silhouette of a seeded sample of 2,000 customers, grouped by payer."""
    c = A.table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", (F.col("c_acctbal").cast("double") / 1000).alias("x"), F.col("c_nationkey").alias("y"))
    return _round(MD.silhouette_rows(c, ["x", "y"], "c_mktsegment", ["c_custkey"], _SAMPLE_SIZE), ["own", "other", "silhouette"])


_PARTS = ["fill_number - 8", "supply_days - prev_gap", "was_late * 40 - 10"]
_NAMES = ["history", "gap", "late"]


def _contributions(spark, sf):
    t = training_table(spark, sf)
    return t.select("patient_age", "runout_dt", "fill_number", "prev_gap",
                    F.array(*[F.expr(p).cast("double") for p in _PARTS]).alias("contributions"))


@register("contribution_summary", f"{TT_SQL} " + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(AVG(abs({p})), 6) AS mean_abs_attribution FROM tt" for n, p in zip(_NAMES, _PARTS)))
def contribution_summary(spark, sf):
    """Mean absolute contribution per feature, over stated contributions."""
    return _round(AT.attribution_summary(_contributions(spark, sf), _NAMES), ["mean_abs_attribution"])


_LISTED = ", ".join(f"{{'feature': '{n}', 'value': CAST({p} AS DOUBLE), 'i': {i}}}" for i, (n, p) in enumerate(zip(_NAMES, _PARTS)))


@register("contribution_top", f"""{TT_SQL}, c AS (SELECT row_number() OVER () AS rid, patient_age, runout_dt, fill_number, prev_gap,
  unnest([{_LISTED}]) AS p FROM tt),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(p['value']) DESC, p['i']) AS k FROM c)
SELECT patient_age, runout_dt, fill_number, prev_gap, string_agg(p['feature'], ',' ORDER BY k) AS features,
       SUM(p['value']) AS total FROM r WHERE k <= 2 GROUP BY rid, patient_age, runout_dt, fill_number, prev_gap""")
def contribution_top(spark, sf):
    """The two features with the largest absolute contribution of every row
    (ties in feature order)."""
    t = AT.top_contributions(_contributions(spark, sf), _NAMES, 2)
    return t.select("patient_age", "runout_dt", "fill_number", "prev_gap",
                    F.array_join(F.transform("top", lambda x: x["feature"]), ",").alias("features"),
                    F.aggregate("top", F.lit(0.0), lambda s, x: s + x["value"]).alias("total"))


@register("flat_windows", f"""WITH w AS ({QD.DEMAND_WINDOWS_SQL})
SELECT drug_id, date, 28 AS n, round("window"[1], 6) AS first_value, round("window"[28], 6) AS last_value,
       round(list_sum(list_transform("window", lambda x: (x - scale) * (x - scale))) / 28, 4) AS mse FROM w""")
def flat_windows(spark, sf):
    """28-value windows as feature vectors, and the mean squared
    difference of a window from a constant one."""
    w = P.flatten_window(QD.demand_windows(spark, sf))
    x = vector_to_array("features")
    w = w.withColumn("x", x).withColumn("flat", F.array_repeat(F.col("scale"), 28))
    return w.select("drug_id", "date", F.size("x").alias("n"), F.round(F.col("x")[0], 6).alias("first_value"),
                    F.round(F.col("x")[27], 6).alias("last_value"), F.round(row_mse("x", "flat"), 4).alias("mse"))
