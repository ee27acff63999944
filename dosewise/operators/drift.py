"""Population stability index.

All features are handled in one pass: the base and live tables are
unpivoted to (feature, value), cut points come from exact distributed
quantiles of the base, every value gets its bucket by counting interior cut
points below or equal to it ([a, b) buckets, the open ends at +-inf), and
shares are counted per (feature, side, bucket).  Empty buckets are
enumerated from the cut table (sequence + explode), never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.functions.scalars import band
from dosewise.operators.stats import exact_quantiles
from dosewise.session import stored

NUMERIC = ["patient_age", "supply_days", "fill_number", "prev_gap", "avg_gap", "was_late", "pct_late"]
DRIFTS_BY_DESIGN = ["fill_number"]


def unpivot(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value) rows for the given numeric columns."""
    return unpivot_with(df, cols, [])


def cut_probs(bins: int = 10) -> list[float]:
    """The probabilities the reference uses: np.linspace(0, 1, bins + 1),
    with its floating artefacts (0.30000000000000004, 0.6000000000000001...)."""
    import numpy as np
    return [float(x) for x in np.linspace(0, 1, bins + 1)]


def psi_cuts(base: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """Per feature the unique decile cut points of the base (numpy's
    linear method on np.linspace probabilities) and the interior cuts that
    separate buckets."""
    q = exact_quantiles(unpivot(base, cols), ["feature"], "value", cut_probs(bins), method="numpy")
    u = F.array_sort(F.array_distinct("quantiles"))
    return q.select("feature", u.alias("cuts"),
                    F.when(F.size(u) >= 2, F.slice(u, 2, F.size(u) - 2))
                    .otherwise(F.array().cast("array<double>")).alias("interior"),
                    (F.size(u) - 1).alias("n_buckets"))


def bucket_shares(df: DataFrame, cols: list[str], cuts: DataFrame, floor: float = 1e-6,
                  side: str | None = None) -> DataFrame:
    """Share of rows per (feature, bucket) - per (side, feature, bucket)
    when ``side`` names a grouping column - floored at ``floor``; every
    bucket of the cut table appears.  Totals come from the same aggregate
    (the counts of one feature sum to the row count), so the table is read
    once."""
    sides = [side] if side else []
    u = unpivot_with(df, cols, sides).join(F.broadcast(cuts.select("feature", "interior")), "feature")
    u = u.withColumn("bucket", F.size(F.filter("interior", lambda c: c <= F.col("value"))))
    cnt = u.groupBy(*sides, "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.groupBy(*sides, "feature").agg(F.sum("n").alias("_tot"))
    allb = cuts.filter(F.col("n_buckets") >= 1).select(
        "feature", F.explode(F.sequence(F.lit(0), F.col("n_buckets") - 1)).alias("bucket"))
    if side:
        allb = allb.join(F.broadcast(tot.select(side, "feature")), "feature")
    s = allb.join(cnt, [*sides, "feature", "bucket"], "left").join(tot, [*sides, "feature"], "left")
    share = F.coalesce(F.col("n"), F.lit(0)) / F.greatest(F.coalesce(F.col("_tot"), F.lit(1)), F.lit(1))
    return s.select(*sides, "feature", "bucket", F.greatest(share, F.lit(floor)).alias("share"))


def unpivot_with(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """(kept columns, feature, value) rows for the given numeric columns."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_u")
    ).select(*keep, "_u.feature", "_u.value")


def psi_sides(df: DataFrame, live: str, cols: list[str] = NUMERIC, bins: int = 10,
              floor: float = 1e-6) -> DataFrame:
    """E22 over one table: rows with ``live`` false are the baseline, true
    the live data.

    The table is read once: it is unpivoted and aggregated to (side, feature,
    value, count), which is written to the shared checkpoint folder.  Cut
    points are weighted exact quantiles of the baseline counts; bucket shares
    are sums of counts.  Every later step works on that small table."""
    vc = stored(unpivot_with(df, cols, [live]).filter(F.col("value").isNotNull())
                .groupBy(live, "feature", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    q = exact_quantiles(vc.filter(~F.col(live)), ["feature"], "value", cut_probs(bins), weight="n",
                        method="numpy")
    u = F.array_sort(F.array_distinct("quantiles"))
    cuts = stored(q.select("feature", F.when(F.size(u) >= 2, F.slice(u, 2, F.size(u) - 2))
                           .otherwise(F.array().cast("array<double>")).alias("interior"),
                           (F.size(u) - 1).alias("n_buckets")), "cuts")
    b = vc.join(F.broadcast(cuts.select("feature", "interior")), "feature")
    b = b.withColumn("bucket", F.size(F.filter("interior", lambda c: c <= F.col("value"))))
    cnt = b.groupBy(live, "feature", "bucket").agg(F.sum("n").alias("n"))
    tot = vc.groupBy(live, "feature").agg(F.sum("n").alias("_tot"))
    allb = cuts.filter(F.col("n_buckets") >= 1).select(
        "feature", F.explode(F.sequence(F.lit(0), F.col("n_buckets") - 1)).alias("bucket"))
    sides = tot.select(live, "feature")
    grid = allb.join(F.broadcast(sides), "feature")
    sh = grid.join(cnt, [live, "feature", "bucket"], "left").join(tot, [live, "feature"], "left")
    sh = sh.select(live, "feature", "bucket", F.greatest(
        F.coalesce(F.col("n"), F.lit(0)) / F.greatest(F.col("_tot"), F.lit(1)), F.lit(floor)).alias("share"))
    e = sh.filter(~F.col(live)).select("feature", "bucket", F.col("share").alias("e"))
    a = sh.filter(F.col(live)).select("feature", "bucket", F.col("share").alias("a"))
    p = e.join(a, ["feature", "bucket"]).groupBy("feature").agg(
        F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))
    return cuts.select("feature").join(p, "feature", "left").select(
        "feature", F.coalesce(F.col("psi"), F.lit(0.0)).alias("psi"))


def psi(base: DataFrame, live: DataFrame, cols: list[str] = NUMERIC, bins: int = 10,
        floor: float = 1e-6) -> DataFrame:
    """PSI per feature = sum over buckets of (a - e) ln(a / e).  A
    feature with no bucket (constant base) gets 0."""
    both = (base.select(*cols).withColumn("_live", F.lit(False))
            .unionByName(live.select(*cols).withColumn("_live", F.lit(True))))
    return psi_sides(both, "_live", cols, bins, floor)


def verdict(report: DataFrame, col: str = "psi") -> DataFrame:
    """<= 0.10 stable, <= 0.25 watch, else RETRAIN (right-closed)."""
    return report.withColumn("verdict", band(col, [0.1, 0.25], ["stable", "watch", "RETRAIN"], right_closed=True))


def alerts(report: DataFrame, by_design=DRIFTS_BY_DESIGN, cut: float = 0.25) -> DataFrame:
    """Behavioural features (not drifting by design) with PSI over ``cut``."""
    return report.filter(~F.col("feature").isin(list(by_design)) & (F.col("psi") > cut))
