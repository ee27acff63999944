"""Course history: gaps, labels and leak-free features.

A *course* is one patient on one drug.  Everything here is a window over the
course ordered by pickup day plus a unique tie key, so the result does not
depend on input order or partition count.

One pass serves every course query, whatever the sizes of the courses.  A count
per course (combined before its shuffle) finds the courses with more rows than a
task's share; there are fewer of those than tasks.  Their rows get the number of
a slice of the course, by bounds from a bounded sample; all other courses are one
slice.  The windows run per (slice, course), so the facts are shuffled once and no
task gets more than a share.  Only cut courses need their slices joined: a table
of one row per slice carries counts, sums and neighbouring days across the
bounds.  Without a cut course the planner drops that branch.  Expanding means use
explicit ROWS frames (a RANGE frame would fold same-day peers into the current
row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.functions.scalars import age_365, flag, runout
from dosewise.session import stored
from dosewise.sources.adapter import ORDER

KEYS = ["patient_id", "drug_id"]


RANGE = "_range"


def slice_window(keys=KEYS, order=ORDER):
    """The window over a course's slice in one range."""
    return Window.partitionBy(RANGE, *keys).orderBy(*order)


def _expanding(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


CUT = "_cut"
PER_SLICE = 64      # sampled rows per slice, from which its bounds are taken


def _same(keys) -> list[Column]:
    """Equal keys of the tables ``d`` and ``b``, a missing key being a key."""
    return [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]


def slice_bounds(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame | None:
    """(keys, bounds: ascending array of structs of ``order``) of the courses that
    have more rows than a task's share; None if there are none.

    The table is written once, so that a task that runs again cuts alike.  It has
    fewer rows than there are shuffle partitions, and less than two bounds per
    partition in all."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, most = per.agg(F.sum("_n"), F.max("_n")).first()
    if not total or parts < 2 or most * parts <= total:
        return None
    large = stored(per.filter(F.col("_n") * parts > total)
                   .withColumn("_s", (F.ceil(F.col("_n") * parts / F.lit(total)) + 1).cast("int")), "large-courses")
    rows = df.alias("d").join(F.broadcast(large.alias("b")), _same(keys)).select(
        *[F.col(f"b.{k}") for k in keys], "_n", "_s", F.struct(*[F.col(f"d.{c}").alias(c) for c in order]).alias("_at"))
    every = F.greatest(F.col("_n") / (F.col("_s") * PER_SLICE), F.lit(1)).cast("long")
    picked = rows.filter(F.pmod(F.xxhash64("_at"), every) == 0)
    sample = picked.groupBy(*keys, "_s").agg(F.array_sort(F.collect_list("_at")).alias("_a"))
    cuts = F.expr("transform(sequence(1, _s - 1), i -> element_at(_a, greatest(1, cast(i * size(_a) / _s as int))))")
    return stored(sample.select(*keys, F.array_distinct(cuts).alias("_bounds")), "bounds")


def ranged(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """``df`` with the slice number of every row (ascending in a course's order)
    and whether its course is cut.  Adds columns only: the one shuffle is that of
    the windows per (slice, keys), and no row is written."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    bounds = slice_bounds(df, keys, order)
    if bounds is None:
        return df.select("*", whole.alias(RANGE), F.lit(False).alias(CUT))
    j = df.alias("d").join(F.broadcast(bounds.alias("b")), _same(keys), "left")
    j = j.select("d.*", "_bounds", F.struct(*[F.col(f"d.{c}").alias(c) for c in order]).alias("_at"))
    # every w-th bound first, then the w bounds from there: few comparisons for many slices
    number = F.expr("transform(array(struct(cast(ceil(sqrt(size(_bounds))) as int) as w)), x -> transform(array(size(filter("
                    "transform(sequence(0, size(_bounds) - 1, x.w), k -> _bounds[k]), c -> c < _at))), k -> "
                    "if(k = 0, 0, (k - 1) * x.w + size(filter(slice(_bounds, (k - 1) * x.w + 1, x.w), c -> c < _at))))[0])[0]")
    return j.select(*[F.col(c) for c in df.columns], F.when(F.col("_bounds").isNull(), whole).otherwise(number).alias(RANGE),
                    F.col("_bounds").isNotNull().alias(CUT))


def of_cut_courses(d: DataFrame, keys=KEYS) -> DataFrame:
    """The rows of cut courses."""
    return d.filter(CUT)


def with_slices(d: DataFrame, per: DataFrame, keys=KEYS) -> DataFrame:
    """``d`` with the columns of ``per``, a table of one row per slice of a cut
    course (fewer than two rows per shuffle partition)."""
    same = [F.col(f"d.{RANGE}") == F.col(f"b.{RANGE}"), *_same(keys)]
    return d.alias("d").join(F.broadcast(per.alias("b")), same, "left").select(
        "d.*", *[F.col(f"b.{c}") for c in per.columns if c not in (RANGE, *keys)])


def across_slices(keys=KEYS):
    """Window over a cut course's slices."""
    return Window.partitionBy(*keys).orderBy(RANGE)


# --- single operators -------------------------------------------------------

def with_gaps(df: DataFrame, out: str = "gap") -> DataFrame:
    """Days since the previous pickup of the same course (NULL first)."""
    h = course_history(df)
    return h.select(*df.columns, F.when(F.col("fill_number") > 1, F.col("prev_gap").cast("int")).alias(out))


def next_date(df: DataFrame, out: str = "next_fill_dt") -> DataFrame:
    """Day of the next pickup of the same course (NULL last)."""
    return course_history(df).select(*df.columns, F.col("next_fill_dt").alias(out))


def ordinal(df: DataFrame, out: str = "fill_number") -> DataFrame:
    """1-based pickup number inside the course."""
    return course_history(df).select(*df.columns, F.col("fill_number").alias(out))


def late_flag(gap, supply, grace: int = 14) -> Column:
    """Late when the gap is strictly longer than supply + grace; a
    missing gap is not late (0)."""
    g = F.col(gap) if isinstance(gap, str) else gap
    s = F.col(supply) if isinstance(supply, str) else supply
    return flag(g > s + F.lit(grace))


def early_flag(gap, supply, frac: float = 0.75) -> Column:
    """Early when the gap is strictly shorter than frac x supply."""
    g = F.col(gap) if isinstance(gap, str) else gap
    s = F.col(supply) if isinstance(supply, str) else supply
    return flag(g < s * F.lit(frac))


def enrich_gaps(df: DataFrame, grace: int = 14) -> DataFrame:
    """Gap and late flag per pickup (first pickup: gap NULL, late 0)."""
    g = with_gaps(df)
    return g.withColumn("late", late_flag("gap", "supply_days", grace))


def refill_label(df: DataFrame, grace: int = 14) -> DataFrame:
    """Run-out day, days late at the next pickup and the label came_back
    (1 when the next pickup is at most ``grace`` days after run-out; no next
    pickup counts as 0)."""
    return course_history(df, grace).select(*df.columns, "next_fill_dt", "runout_dt", "days_late", "came_back")


def refill_features(df: DataFrame, grace: int = 14) -> DataFrame:
    """D3: leak-free features known on the pickup day."""
    return course_history(df, grace=grace)


# --- the combined pass --------------------------------------------------------

def _in_slice(d: DataFrame, grace: int) -> DataFrame:
    """Everything that a slice knows by itself; its first row counts as a
    course's first pickup."""
    w = slice_window()
    we = _expanding(w)
    d = d.select("*", F.lead("fill_dt").over(w).alias("_lead"), F.row_number().over(w).alias("_rn"),
                 F.coalesce(F.datediff(F.col("fill_dt"), F.lag("fill_dt").over(w)), F.col("supply_days"))
                 .cast("double").alias("_gap"))
    d = d.withColumn("_late", late_flag("_gap", "supply_days", grace))
    return d.select("*", F.sum("_gap").over(we).alias("_gaps"), F.sum("_late").over(we).alias("_lates"))


def _corrections(d: DataFrame, grace: int) -> DataFrame:
    """One row per slice of a cut course: what its rows lack from the slices
    before and after."""
    per = (_in_slice(of_cut_courses(d), grace).groupBy(RANGE, *KEYS)
           .agg(F.count(F.lit(1)).alias("_n"), F.min("fill_dt").alias("_from"), F.max("fill_dt").alias("_to"),
                F.sum("_gap").alias("_sum_gap"), F.sum("_late").alias("_sum_late"),
                F.min_by(F.struct("_gap", "_late", "supply_days"), "_rn").alias("_one")))
    w = across_slices()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.lag("_to").over(w).alias("_before"), F.lead("_from").over(w).alias("_after"))
    supply = F.col("_one.supply_days")
    per = per.withColumn("_true_gap", F.coalesce(F.datediff("_from", "_before"), supply).cast("double"))
    per = per.withColumn("_true_late", late_flag(F.col("_true_gap"), supply, grace))
    per = per.withColumn("_add_gap", F.col("_true_gap") - F.col("_one._gap"))
    per = per.withColumn("_add_late", F.col("_true_late") - F.col("_one._late"))
    return per.select(
        RANGE, *KEYS, "_after", "_true_gap", "_true_late",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        (F.col("_add_gap") + F.coalesce(F.sum(F.col("_sum_gap") + F.col("_add_gap")).over(before), F.lit(0.0))).alias("_gap0"),
        (F.col("_add_late") + F.coalesce(F.sum(F.col("_sum_late") + F.col("_add_late")).over(before), F.lit(0))).alias("_late0"))


def course_history(df: DataFrame, grace: int = 14) -> DataFrame:
    """Label and features of every pickup in one pass; give it the columns that
    are needed only, they all move.

    Adds: next_fill_dt, runout_dt, days_late, came_back, prev_gap, fill_number,
    was_late, avg_gap, pct_late.
    """
    d = ranged(df)
    j = with_slices(_in_slice(d, grace), _corrections(d, grace))
    cut_first = (F.col("_rn") == 1) & F.col("_n0").isNotNull()
    number = F.col("_rn") + F.coalesce("_n0", F.lit(0))
    out = j.select(
        *df.columns, F.coalesce("_lead", "_after").alias("next_fill_dt"),
        F.when(cut_first, F.col("_true_gap")).otherwise(F.col("_gap")).alias("prev_gap"),
        number.cast("int").alias("fill_number"),
        F.when(cut_first, F.col("_true_late")).otherwise(F.col("_late")).alias("was_late"),
        ((F.col("_gaps") + F.coalesce("_gap0", F.lit(0.0))) / number).alias("avg_gap"),
        ((F.col("_lates") + F.coalesce("_late0", F.lit(0))) / number).alias("pct_late"))
    out = out.withColumn("runout_dt", runout("fill_dt", "supply_days"))
    out = out.withColumn("days_late", F.datediff("next_fill_dt", "runout_dt"))
    out = out.withColumn("came_back", flag(F.col("days_late") <= F.lit(grace)))
    return out.select(*df.columns, "next_fill_dt", "prev_gap", "fill_number", "runout_dt",
                      "days_late", "came_back", "was_late", "avg_gap", "pct_late")


def last_day(df: DataFrame, date: str = "fill_dt") -> Column:
    """A10: the data's last day as a scalar subquery (computed once)."""
    return df.agg(F.max(date)).scalar()


def censor(df: DataFrame, last: Column, runout_col: str = "runout_dt", days: int = 14) -> DataFrame:
    """P10: drop rows whose run-out lies inside the last ``days`` days, where
    the answer is not known yet.  ``last`` is a scalar column (for example
    ``last_day(facts)`` over the fact scan alone, not the joined view)."""
    return df.filter(F.col(runout_col) <= F.date_sub(last, days))


FEATURES = ["patient_age", "drug_name", "is_branded", "supply_days", "fill_number",
            "prev_gap", "was_late", "avg_gap", "pct_late"]
LABEL = "came_back"


def training_table(fills: DataFrame, patients: DataFrame, drugs: DataFrame,
                   grace: int = 14, last: Column | None = None) -> DataFrame:
    """The model table - 9 features, run-out day and label.

    One course pass, then censoring, then two dimension joins that the planner
    broadcasts when the dimension is small and otherwise sort-merges.
    """
    h = course_history(fills.select("patient_id", "drug_id", "fill_dt", "supply_days", *ORDER[1:]),
                       grace=grace)
    h = censor(h, last if last is not None else last_day(fills), days=grace)
    t = (h.join(patients.select("patient_id", "birth_dt"), "patient_id")
          .join(drugs.select("drug_id", "drug_name", "is_branded"), "drug_id"))
    t = t.withColumn("patient_age", age_365("fill_dt", "birth_dt"))
    return t.select(*FEATURES, "runout_dt", LABEL)
