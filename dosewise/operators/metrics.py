"""Evaluation metrics on scored tables.

A scored table has ``score`` (probability of the positive class, or an
oddness score) and ``label`` 0/1.  Every metric is one aggregate pass; tables
with one row per cut-off or class are produced by ``stack`` over the
aggregate row, never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.operators.stats import exact_quantiles, global_index


def accuracy(scored: DataFrame, cut: float = 0.5, score: str = "score", label: str = "label") -> DataFrame:
    """Share of rows where (score >= cut) equals the label."""
    pred = (F.col(score) >= F.lit(cut)).cast("int")
    return scored.agg(F.avg((pred == F.col(label)).cast("double")).alias("accuracy"))


def lazy_baseline(scored: DataFrame, label: str = "label") -> DataFrame:
    """M7: accuracy of always answering 1."""
    return scored.agg(F.avg((F.col(label) == 1).cast("double")).alias("lazy_accuracy"))


def _cells(scored, cut, score, label):
    pred = F.col(score) >= F.lit(cut)
    y = F.col(label) == 1
    s = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return scored.agg(s(~y & ~pred).alias("tn"), s(~y & pred).alias("fp"),
                      s(y & ~pred).alias("fn"), s(y & pred).alias("tp"))


def confusion(scored: DataFrame, cut: float = 0.5, score: str = "score", label: str = "label") -> DataFrame:
    """2x2 confusion matrix, rows actual 0/1, columns predicted 0/1."""
    c = _cells(scored, cut, score, label)
    return c.select(F.expr("stack(2, 0, tn, fp, 1, fn, tp) AS (actual, pred_0, pred_1)"))


def class_report(scored: DataFrame, cut: float = 0.5, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and
    support-weighted averages (0 where a ratio has a zero denominator)."""
    c = _cells(scored, cut, score, label)
    z = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tn, fp, fn, tp = (F.col(x) for x in ["tn", "fp", "fn", "tp"])
    p0, r0 = z(tn, tn + fn), z(tn, tn + fp)
    p1, r1 = z(tp, tp + fp), z(tp, tp + fn)
    f = lambda p, r: F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    s0, s1 = (tn + fp).cast("double"), (fn + tp).cast("double")
    c = c.select(p0.alias("p0"), r0.alias("r0"), f(p0, r0).alias("f0"), s0.alias("s0"),
                 p1.alias("p1"), r1.alias("r1"), f(p1, r1).alias("f1"), s1.alias("s1"))
    tot = F.col("s0") + F.col("s1")
    wavg = lambda a, b: (F.col(a) * F.col("s0") + F.col(b) * F.col("s1")) / tot
    c = c.select("*", ((F.col("p0") + F.col("p1")) / 2).alias("mp"), ((F.col("r0") + F.col("r1")) / 2).alias("mr"),
                 ((F.col("f0") + F.col("f1")) / 2).alias("mf"), wavg("p0", "p1").alias("wp"),
                 wavg("r0", "r1").alias("wr"), wavg("f0", "f1").alias("wf"), tot.alias("st"))
    return c.select(F.expr(
        "stack(4, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, 'macro avg', mp, mr, mf, st, "
        "'weighted avg', wp, wr, wf, st) AS (class, precision, recall, f1, support)"))


def threshold_table(scored: DataFrame, cuts=(0.4, 0.5, 0.6, 0.7, 0.8), score: str = "score",
                    label: str = "label") -> DataFrame:
    """For each cut-off: rows we call (score < cut), caught (called,
    label 0), missed (not called, label 0), wasted (called, label 1)."""
    y0 = F.col(label) == 0
    aggs = []
    for i, cut in enumerate(cuts):
        risk = F.col(score) < F.lit(cut)
        s = lambda c: F.sum(F.when(c, 1).otherwise(0))
        aggs += [s(risk).alias(f"c{i}"), s(risk & y0).alias(f"k{i}"),
                 s(~risk & y0).alias(f"m{i}"), s(risk & ~y0).alias(f"w{i}")]
    row = scored.agg(*aggs)
    parts = ", ".join(f"CAST({c} AS DOUBLE), c{i}, k{i}, m{i}, w{i}" for i, c in enumerate(cuts))
    return row.select(F.expr(f"stack({len(cuts)}, {parts}) AS (cutoff, calls, caught, missed, wasted)"))


def mae(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mean absolute error."""
    return df.agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"))


def mape(df: DataFrame, y: str, p: str, floor: float = 1.0) -> DataFrame:
    """Mean absolute percentage error (denominator floored), in percent."""
    return df.agg((F.avg(F.abs(F.col(y) - F.col(p)) / F.greatest(F.col(y), F.lit(float(floor)))) * 100).alias("mape"))


BUDGETS = (0.01, 0.02, 0.03, 0.05, 0.08)


def budget_topk(scored: DataFrame, key: str, budgets=BUDGETS, score: str = "score") -> DataFrame:
    """For each budget b, the floor(n x b) rows with the largest score
    (ties to the lowest key).  One global index over the order, then a
    filter per budget; returns (budget, key, score)."""
    n = scored.count()
    idx = global_index(scored.select(key, score), [F.col(score).desc(), F.col(key).asc()])
    parts = None
    for b in budgets:
        k = int(n * b)
        p = idx.filter(F.col("row_idx") < k).select(F.lit(float(b)).alias("budget"), key, score)
        parts = p if parts is None else parts.unionByName(p)
    return parts


def quantile_flags(scored: DataFrame, key: str, budgets=BUDGETS, score: str = "score") -> DataFrame:
    """T10 quantile rule: flag rows whose score lies strictly below the
    budget quantile of all scores (lower = odder).  Returns (budget, key, score)."""
    q = exact_quantiles(scored.withColumn("_g", F.lit(0)), ["_g"], score, list(budgets))
    cuts = q.select(F.posexplode("quantiles").alias("_i", "_cut"))
    blist = F.array(*[F.lit(float(b)) for b in budgets])
    cuts = cuts.select(F.element_at(blist, F.col("_i") + 1).alias("budget"), "_cut")
    return (scored.select(key, score).join(F.broadcast(cuts), F.col(score) < F.col("_cut"))
            .select("budget", key, score))


def review_budget(flags: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Per budget: flagged, caught (flagged and in the answer key),
    false alarms (flagged, not in the key)."""
    k = known.select(key).distinct().withColumn("_known", F.lit(1))
    j = flags.join(k, key, "left")
    return j.groupBy("budget").agg(
        F.count(F.lit(1)).alias("flagged"),
        F.count("_known").alias("caught"),
        F.sum(F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("false_alarms"))
