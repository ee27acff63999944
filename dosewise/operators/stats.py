"""Distributed order statistics: exact quantiles, global row index, exact
ROC-AUC (A7, A15, W12, W13, E2).

None of these uses an unpartitioned window over the data:

* quantiles: values are first aggregated to (group, value, count); a sketch cuts
  them into ranges, range counts locate the order statistics, and only the ranges
  that hold one are sorted.
* global index: a range-partitioned sort, per-partition row counts (one row
  per partition), prefix offsets, and a broadcast join of the offsets.
* AUC: scores are aggregated to distinct values with positive/negative
  counts, cut into ~256 score ranges by approximate quantiles; prefix sums
  run per range and are offset by a small per-range table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.session import cut_lineage, stored


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs: list[float],
                    n_ranges: int = 64, weight: str | None = None, method: str = "linear") -> DataFrame:
    """Linear-interpolation quantiles (numpy 'linear', SQL quantile_cont) per
    group, exact.  Returns group columns + ``quantiles`` (array in the order
    of ``probs``).  NULL values are ignored; a group without values has no row.

    Values are aggregated to (group, value, count), written once.  Each group's
    distinct values are cut into up to ``n_ranges`` ranges by a quantile sketch;
    the rows per range (one array per group) tell which ranges hold the order
    statistics that the probabilities ask for, and only the values of those ranges
    are sorted, range by range.  So one large group never lies in one task, and
    the exact step moves a few ranges, not the table.

    ``weight`` names a column of row multiplicities (the input is already a
    value-count table, which is then not written again).

    ``method="numpy"`` reproduces numpy's linear method operation for
    operation: virtual index (n - 1) * q with clipped neighbours, and
    interpolation from the upper value when the fraction is at least 0.5.  With probabilities from
    ``np.linspace`` (0.6000000000000001 ...) a cut can land a hair above a
    data value, which moves that value's bucket; the reference's PSI depends
    on it."""
    some = df.filter(F.col(value).isNotNull())
    if weight:
        vc = some.select(*group, F.col(value).cast("double").alias("_v"), F.col(weight).cast("long").alias("_c"))
    else:
        vc = stored(some.groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "values")
    rprobs = [i / n_ranges for i in range(1, n_ranges)]
    edges = vc.groupBy(*group).agg(F.array_distinct(F.percentile_approx("_v", rprobs, 10000)).alias("_e"))
    edges = stored(edges, "edges")
    vc = vc.join(edges, group).withColumn("_r", F.size(F.filter("_e", lambda e: e < F.col("_v")))).drop("_e")
    per = vc.groupBy(*group, "_r").agg(F.sum("_c").alias("_rc")).groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("_r", "_rc"))).alias("_a"))      # at most n_ranges entries
    n = F.aggregate("_a", F.lit(0).cast("long"), lambda s, x: s + x["_rc"])
    pr = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("q")) for i, p in enumerate(probs)])
    pos = per.select(*group, "_a", n.alias("_n"), F.explode(pr).alias("_p"))
    h = (F.col("_n") - 1) * F.col("_p.q")
    if method == "numpy":
        lo = F.least(F.greatest(F.floor(h), F.lit(0)), F.col("_n") - 1)
        ends = F.array(lo, F.least(lo + 1, F.col("_n") - 1))
    else:
        ends = F.array(F.floor(h), F.ceil(h))
    # the range that holds an order statistic, and the rows before that range
    at = pos.select(*group, "_a", F.col("_p.qi").alias("qi"), h.alias("_h"), F.posexplode(ends).alias("_side", "_k"))
    place = F.expr("aggregate(_a, struct(cast(0 as long) as before, cast(-1 as int) as r, cast(0 as long) as off), (s, x) -> "
                   "struct(s.before + x._rc as before, if(s.r < 0 and _k < s.before + x._rc, x._r, s.r) as r, "
                   "if(s.r < 0 and _k < s.before + x._rc, s.before, s.off) as off))")
    at = at.select(*group, "qi", "_h", "_side", "_k", place.alias("_w")).select(
        *group, "qi", "_h", "_side", "_k", F.col("_w.r").alias("_r"), F.col("_w.off").alias("_off"))
    at = stored(at, "positions")
    w = Window.partitionBy(*group, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = vc.join(at.select(*group, "_r").distinct(), [*group, "_r"], "left_semi")
    near = near.select(*group, "_r", "_v", "_c", F.sum("_c").over(w).alias("_cum"))
    hit = near.join(at, [*group, "_r"]).filter((F.col("_cum") - F.col("_c") <= F.col("_k") - F.col("_off"))
                                               & (F.col("_k") - F.col("_off") < F.col("_cum")))
    q = hit.groupBy(*group, "qi").agg(
        F.max("_h").alias("_h"), F.max(F.when(F.col("_side") == 0, F.col("_k"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_vlo"), F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_vhi"))
    g = F.col("_h") - F.col("_lo")
    d = F.col("_vhi") - F.col("_vlo")
    if method == "numpy":
        val = F.when(g >= 0.5, F.col("_vhi") - d * (F.lit(1.0) - g)).otherwise(F.col("_vlo") + d * g)
    else:
        val = F.col("_vlo") + d * g
    q = q.select(*group, "qi", val.alias("_q"))
    # one row per group: array ordered by probability index (bounded by len(probs))
    return q.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("qi", "_q"))), lambda s: s["_q"]).alias("quantiles"))


def sums_before(small: DataFrame, key: str, sums: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """For a table of a few rows (one per partition or range) the sum of each
    column over the rows with a smaller key, as an array expression: one row,
    no window over the whole table."""
    from dosewise.operators.running import running_sums
    rows = small.agg(F.array_sort(F.collect_list(F.struct(key, *sums, *keep))).alias("_a"))
    e = rows.select(F.explode(F.arrays_zip("_a", *[F.expr(running_sums("_a", c)).alias(f"_s{i}") for i, c in enumerate(sums)])).alias("_z"))
    return e.select(F.col("_z._a")[key].alias(key), *[F.col("_z._a")[c].alias(c) for c in keep],
                    *[F.col(f"_z._s{i}").alias(out) for i, out in enumerate(sums.values())])


def global_index(df: DataFrame, order: list, out: str = "row_idx") -> DataFrame:
    """0-based position of every row in a total order, without moving
    all rows to one task.  The sorted data and its offsets are written once
    (shared folder), so the partition layout used for the counts is the one
    indexed, and later reads prune columns."""
    srt = stored(df.orderBy(*order).withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()), "indexed")
    counts = srt.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"), F.min("_mid").alias("_m0"))
    offs = stored(sums_before(counts, "_pid", {"_pc": "_off"}, ["_m0"]), "offsets")
    j = srt.join(F.broadcast(offs), "_pid")
    return j.select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_m0")).alias(out))


def score_ranks(scored: DataFrame, score: str = "score", label: str = "label",
                n_ranges: int = 256) -> DataFrame:
    """Per distinct score: positives, negatives, negatives with a lower
    score and the average rank (ties averaged) of that score."""
    d = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("n_neg"))
    probs = [i / n_ranges for i in range(1, n_ranges)]
    # range edges: at most n_ranges - 1 approximate quantiles of the distinct
    # scores, a bounded list fetched to the driver like any cut points
    row = d.agg(F.percentile_approx("s", probs, 10000).alias("e")).first()
    edges = sorted(set(row["e"] or []))
    lit_edges = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>")
    d = d.withColumn("_r", F.size(F.filter(lit_edges, lambda e: e < F.col("s"))))
    per = d.groupBy("_r").agg(F.sum("n_pos").alias("_rp"), F.sum("n_neg").alias("_rn"))
    per = sums_before(per, "_r", {"_rp": "_op", "_rn": "_on"})
    w = Window.partitionBy("_r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.select("*", F.coalesce(F.sum("n_pos").over(w), F.lit(0)).alias("_bp"),
                 F.coalesce(F.sum("n_neg").over(w), F.lit(0)).alias("_bn"))
    d = d.join(F.broadcast(per), "_r")
    below = F.col("_bp") + F.col("_bn") + F.col("_op") + F.col("_on")
    tied = F.col("n_pos") + F.col("n_neg")
    return d.select("s", "n_pos", "n_neg", (F.col("_bn") + F.col("_on")).alias("neg_below"),
                    (below + (tied + 1) / F.lit(2.0)).alias("avg_rank"))


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact ROC-AUC with ties counted half (Mann-Whitney).  One row."""
    r = score_ranks(scored, score, label)
    agg = r.agg(F.sum(F.col("n_pos") * (F.col("neg_below") + F.col("n_neg") / F.lit(2.0))).alias("_u"),
                F.sum("n_pos").alias("_p"), F.sum("n_neg").alias("_n"))
    return agg.select(F.try_divide(F.col("_u"), F.col("_p") * F.col("_n")).alias("auc"))


def grouped_auc(scored: DataFrame, group: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """E2 per group, exact, ties counted half: group columns and ``auc`` (null
    for a group of one class).

    Distinct (group, score) counts are dealt by ranges, so a large group lies in
    many tasks; negatives below a range come from one row per group and range."""
    d = scored.groupBy(*group, F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("n_neg"))
    d = cut_lineage(d.repartitionByRange(*group, "s").withColumn("_r", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    per = d.groupBy(*group, "_r").agg(F.sum("n_neg").alias("_rn"))
    per = per.select(*group, "_r", F.coalesce(F.sum("_rn").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*group, "_r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.select("*", F.coalesce(F.sum("n_neg").over(w), F.lit(0)).alias("_below")).join(per, [*group, "_r"])
    below = F.col("_below") + F.col("_off") + F.col("n_neg") / F.lit(2.0)
    return d.groupBy(*group).agg(F.try_divide(F.sum(F.col("n_pos") * below), F.sum("n_pos") * F.sum("n_neg")).alias("auc"))


def quantile_of(df: DataFrame, value: str, prob: float) -> Column:
    """Exact linear quantile of one column as a scalar subquery column."""
    q = exact_quantiles(df.withColumn("_g", F.lit(0)), ["_g"], value, [prob])
    return q.select(F.col("quantiles")[0]).scalar()
