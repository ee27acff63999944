"""Per-patient behaviour profiles (A4, A5, D14, D15) and refill sequences
(W9, D12, D13).

A profile is one window pass over courses (for the gap) and one grouped
aggregate per patient; the aggregate is partial, so only one row per patient
and task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.functions.scalars import (age_365, arr_last, arr_mean, arr_share_over, arr_std,
                                        clip_low, flag, ratio, runout)
from dosewise.operators.courses import (KEYS, RANGE, across_slices, late_flag, of_cut_courses, ranged,
                                        slice_window, with_gaps, with_slices)
from dosewise.sources.adapter import ORDER


def profile(df: DataFrame, key: str, specs: dict[str, Column]) -> DataFrame:
    """A4/A5: one grouped aggregate with named outputs, then drop rows with
    any missing value (a mean over no values)."""
    return df.groupBy(key).agg(*[c.alias(n) for n, c in specs.items()]).dropna("any")


def patient_profile(fills: DataFrame, patients: DataFrame, as_of: Column, grace: int = 14,
                    ratio_scale: int | None = None) -> DataFrame:
    """Share of late pickups (first pickups count as not late), mean
    gap/supply ratio, pickups, distinct drugs, mean copay and age at
    ``as_of`` (days / 365).

    A floating-point mean depends on summation order (partition layout).
    With ``ratio_scale`` (e.g. 10**9) each ratio is fixed to 1/ratio_scale by
    integer division and the ratios are summed as integers, so the mean is
    the same double on every run and engine."""
    g = with_gaps(fills.select(*KEYS, "supply_days", "copay", *ORDER))
    g = g.withColumn("late_ratio", ratio("gap", "supply_days"))
    g = g.withColumn("late", late_flag("gap", "supply_days", grace))
    if ratio_scale:
        fixed = F.expr(f"CAST(gap AS BIGINT) * {int(ratio_scale)} div supply_days")
        mean_ratio = F.sum(fixed).cast("double") / F.count("gap") / F.lit(float(ratio_scale))
    else:
        mean_ratio = F.avg("late_ratio")
    p = profile(g, "patient_id", {
        "pct_late": F.avg("late"),
        "avg_late_ratio": mean_ratio,
        "n_fills": F.count(F.lit(1)),
        "n_drugs": F.countDistinct("drug_id"),
        "avg_copay": F.avg("copay"),
    })
    p = p.join(patients.select("patient_id", "birth_dt"), "patient_id", "left")
    return p.withColumn("age", age_365(as_of, "birth_dt")).drop("birth_dt")


def controlled_fills(fills: DataFrame, drugs: DataFrame) -> DataFrame:
    """Pickups of controlled drugs (semi join on the filtered dimension)."""
    return fills.join(drugs.filter(F.col("drug_class") > 0).select("drug_id"), "drug_id", "left_semi")


def controlled_profile(fills: DataFrame, drugs: DataFrame, frac: float = 0.75) -> DataFrame:
    """For patients on a controlled drug: pickups, mean gap, shortest gap,
    share of early pickups (first counts as not early), mean days of supply
    left at pickup (first pickup skipped), total quantity."""
    c = with_gaps(controlled_fills(fills, drugs).select(*KEYS, "supply_days", "disp_qty", *ORDER))
    c = c.withColumn("early_days", clip_low(F.col("supply_days") - F.col("gap"), 0))
    c = c.withColumn("is_early", flag(F.col("gap") < F.col("supply_days") * F.lit(frac)))
    return profile(c, "patient_id", {
        "fills": F.count(F.lit(1)),
        "avg_gap": F.avg("gap"),
        "min_gap": F.min("gap"),
        "pct_early": F.avg("is_early"),
        "avg_early_days": F.avg("early_days"),
        "total_qty": F.sum("disp_qty"),
    })


def refill_windows(fills: DataFrame, last: Column, n: int = 6, grace: int = 14) -> DataFrame:
    """Label and gap ratio per pickup, censored at ``last`` - grace,
    then for every pickup with index >= n (0-based, after censoring) the last
    n gap ratios including its own.  Windows with a missing ratio are dropped.

    The windows run per slice of a course (``courses.ranged``); the first rows
    of a cut course's slice take the ratios before them from the slices before.
    """
    d = ranged(fills.select(*KEYS, "supply_days", *ORDER))
    w = slice_window()
    across = across_slices()

    def labelled(x: DataFrame) -> DataFrame:
        x = x.select("*", F.lead("fill_dt").over(w).alias("next_fill"), F.lag("fill_dt").over(w).alias("_prev"),
                     F.row_number().over(w).alias("_rn"))
        return x

    ends = (of_cut_courses(d).groupBy(RANGE, *KEYS).agg(F.min("fill_dt").alias("_from"), F.max("fill_dt").alias("_to"))
            .select(RANGE, *KEYS, F.lag("_to").over(across).alias("_before"), F.lead("_from").over(across).alias("_after")))

    def known(x: DataFrame) -> DataFrame:
        f = with_slices(labelled(x), ends)
        f = f.withColumn("next_fill", F.coalesce("next_fill", "_after"))
        f = f.withColumn("gap", F.datediff("fill_dt", F.coalesce("_prev", F.when(F.col("_rn") == 1, F.col("_before")))))
        f = f.withColumn("runout", runout("fill_dt", "supply_days"))
        f = f.withColumn("came_back", flag(F.datediff("next_fill", "runout") <= F.lit(grace)))
        f = f.withColumn("ratio", ratio("gap", "supply_days"))
        f = f.filter(F.col("runout") <= F.date_sub(last, grace))
        one = F.struct(F.col("ratio").alias("v"))   # keeps missing ratios in their places
        return f.select(*KEYS, RANGE, *ORDER, "runout", "came_back", F.row_number().over(w).alias("_k"),
                        F.collect_list(one).over(w.rowsBetween(-(n - 1), 0)).alias("_here"))

    tails = (known(of_cut_courses(d)).groupBy(RANGE, *KEYS)
             .agg(F.max("_k").alias("_n"), F.max_by("_here", "_k").alias("_tail"))
             .select(RANGE, *KEYS,
                     F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_n0"),
                     F.flatten(F.collect_list("_tail").over(across.rowsBetween(-n, -1))).alias("_carry")))
    f = with_slices(known(d), tails)
    whole = F.concat(F.coalesce("_carry", F.array().cast("array<struct<v:double>>")), F.col("_here"))
    f = f.select("*", (F.col("_k") - 1 + F.coalesce("_n0", F.lit(0))).cast("int").alias("idx"),
                 F.slice(whole, F.greatest(F.size(whole) - (n - 1), F.lit(1)), n).alias("_w"))
    f = f.filter((F.col("idx") >= n) & ~F.exists("_w", lambda x: x["v"].isNull()))
    return f.select(*KEYS, "fill_dt", "idx", F.col("_w.v").alias("window"), "came_back", "runout")


def window_summary(df: DataFrame, col: str = "window", cut: float = 1.4) -> DataFrame:
    """Mean, population std, last value and share over ``cut``."""
    return df.select("*", arr_mean(col).alias("w_mean"), arr_std(col).alias("w_std"),
                     arr_last(col).alias("w_last"), arr_share_over(col, cut).alias("w_share_over"))
