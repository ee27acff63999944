"""General relational operators: filters (P), joins (J), aggregates (A),
ordering (O) and set operations (U).

Joins to dimensions are left to the planner (broadcast below the measured
size threshold, sort-merge otherwise, AQE re-plans at runtime).  The only
explicit broadcasts are of tables whose size is bounded by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.session import stored


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- filters ------------------------------------------------------------------

def project(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep an ordered column list."""
    return df.select(*cols)


def where_all(df: DataFrame, **equals) -> DataFrame:
    """Conjunctive equality filter."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()])
    return df.filter(cond)


def only_items(df: DataFrame, dim: DataFrame, key: str, pred: Column) -> DataFrame:
    """Keep fact rows whose key is in the filtered dimension (semi join)."""
    return df.join(dim.filter(pred).select(key), key, "left_semi")


def exclude(df: DataFrame, col: str, values: list) -> DataFrame:
    """Negated membership against a literal list."""
    return df.filter(~F.col(col).isin(values))


def drop_first(df: DataFrame, col: str = "gap") -> DataFrame:
    """P5: drop rows where ``col`` is missing."""
    return df.filter(F.col(col).isNotNull())


def temporal_split(df: DataFrame, col: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cut`` and rows on/after it (both push to the scan)."""
    c = F.col(col) < F.lit(cut).cast("date")
    return df.filter(c), df.filter(~c)


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with any missing value."""
    return df.dropna("any", subset=cols)


def fill_from(df: DataFrame, col: str, other: str) -> DataFrame:
    """Fill missing values of ``col`` from ``other``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.col(other)))


def without(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)


def mark_members(df: DataFrame, key: str, members: DataFrame, out: str = "is_member") -> DataFrame:
    """Flag rows whose key is in ``members`` (left join on the distinct keys)."""
    m = members.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(m, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def trim(df: DataFrame, col: str, hi: float) -> DataFrame:
    """Keep values strictly below ``hi``."""
    return df.filter(F.col(col) < F.lit(hi))


# --- joins --------------------------------------------------------------------

def enrich(fact: DataFrame, dim: DataFrame, key: str, cols: list[str], how: str = "inner") -> DataFrame:
    """Attach a few dimension columns on a key."""
    return fact.join(dim.select(key, *cols), key, how)


def attach(agg: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Left join an aggregate to a dimension."""
    return enrich(agg, dim, key, cols, "left")


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Anti join."""
    return df.join(other.select(*keys), keys, "left_anti")


# --- aggregates ---------------------------------------------------------------

def sum_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """A1: sum per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def count_by(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """Rows per key (value counts)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def share_by(df: DataFrame, keys: list[str], flag_col: str, out: str) -> DataFrame:
    """A3: mean of a 0/1 or boolean column per key."""
    return df.groupBy(*keys).agg(F.avg(F.col(flag_col).cast("double")).alias(out))


def distinct_by(df: DataFrame, keys: list[str], col: str, out: str, approx: bool = False) -> DataFrame:
    """Distinct count per key (exact, or HyperLogLog++ as opt-in)."""
    agg = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.groupBy(*keys).agg(agg.alias(out))


def describe(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max."""
    c = F.col(col)
    from dosewise.operators.stats import exact_quantiles
    q = exact_quantiles(df.select(F.lit(0).alias("_g"), c.alias("_x")), ["_g"], "_x", [0.25, 0.5, 0.75])
    d = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
               F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    d = d.withColumn("_q", q.select("quantiles").scalar())
    return d.select(*[F.col(x).alias(prefix + x) for x in ["count", "mean", "std", "min"]],
                    F.col("_q")[0].alias(prefix + "p25"), F.col("_q")[1].alias(prefix + "p50"),
                    F.col("_q")[2].alias(prefix + "p75"), F.col("max").alias(prefix + "max"))


def frequent(df: DataFrame, key: str, min_n: int = 8, out: str = "n") -> DataFrame:
    """Keys with at least ``min_n`` rows (HAVING)."""
    return count_by(df, [key], out).filter(F.col(out) >= min_n)


def histogram(df: DataFrame, col: str, bins: int, out_prefix: str = "") -> DataFrame:
    """Equal-width histogram between the column's min and max (last bin
    closed), one row per non-empty bin: bin, lower edge, upper edge, count.

    The min/max come from a one-row aggregate joined back as a scalar."""
    stats = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))).scalar()
    lo, hi = stats["lo"], stats["hi"]
    width = F.try_divide(hi - lo, F.lit(float(bins)))
    raw = F.floor(F.try_divide(F.col(col) - lo, width)).cast("int")
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1))
    h = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("bin", (lo + F.col("bin") * F.coalesce(width, F.lit(0.0))).alias("lower"),
                    (lo + (F.col("bin") + 1) * F.coalesce(width, F.lit(0.0))).alias("upper"), "n")


# --- ordering -----------------------------------------------------------------

def top(df: DataFrame, col: str, n: int, tie: list[str] | None = None, asc: bool = False) -> DataFrame:
    """N rows with the largest (or smallest) value; planned as
    TakeOrderedAndProject (per-task top-n, then a merge)."""
    o = F.col(col).asc() if asc else F.col(col).desc()
    return df.orderBy(o, *[F.col(t).asc() for t in (tie or [])]).limit(n)


def order(df: DataFrame, keys: list) -> DataFrame:
    """O1: multi-key sort for output (range-partitioned; windows and
    aggregates never need it)."""
    return df.orderBy(*keys)


def head(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """O3: the first n rows in key order (a bounded top-n, merged per task)."""
    return df.orderBy(*keys).limit(n)


def slice_rows(df: DataFrame, keys: list[str], order: list[str], lo: int, hi: int,
               out: str = "row_idx") -> DataFrame:
    """0-based rows lo..hi (inclusive) of each ordered group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w) - 1).filter(F.col(out).between(lo, hi))


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each group by the order (an aggregate: min over a
    struct of the order columns, so no row is buffered per group)."""
    rest = [c for c in df.columns if c not in keys]
    s = F.min(F.struct(*[F.col(o) for o in order], *[F.col(c).alias("_v_" + c) for c in rest]))
    g = df.groupBy(*keys).agg(s.alias("_first"))
    return g.select(*keys, *[F.col("_first._v_" + c).alias(c) for c in rest])


def sample_n(df: DataFrame, key: list[str], n: int, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """Seeded sample of exactly n rows, or of n rows per group of ``by``
    (all rows of a smaller one).

    The rows with the n least values of md5("seed|key|...") (ties by key; a
    missing key part is empty text), so the sample depends on neither run nor
    partitioning, and any engine can repeat it.  Samples merge: every task keeps
    its own n least rows (per group, too) and only those are shuffled."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))
    if by is None:
        return df.orderBy(h, *key).limit(n)
    w = Window.partitionBy(*by).orderBy(h, *key)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


# --- set operations -----------------------------------------------------------

def union(*dfs: DataFrame) -> DataFrame:
    """Union all by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def caught(flagged: DataFrame, known: DataFrame) -> DataFrame:
    """Flagged rows that are in the answer key."""
    return flagged.intersect(known)


def false_alarms(flagged: DataFrame, known: DataFrame) -> DataFrame:
    """Flagged rows that are not in the answer key."""
    return flagged.subtract(known)


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row.  The hash function skips missing values, so
    which ones are missing is hashed as well."""
    cols = [F.col(c) for c in df.columns]
    missing = F.concat(*[c.isNull().cast("string") for c in cols])
    return F.xxhash64(missing, *cols), F.xxhash64(F.lit("second"), *cols, missing)


def table_diff(a: DataFrame, b: DataFrame, buckets: int = 4096) -> DataFrame:
    """Rows only in a and rows only in b (multiset difference both ways,
    columns by position), as one table with a side column.

    One pass over each table makes an order-free digest per hash bucket: rows,
    and the sums of two 64-bit hashes of each row (repeated rows count).  Only
    digests are shuffled, at most ``buckets`` rows a task.  Rows are compared, and
    shuffled, in the buckets whose digests differ; none if the tables are equal.
    Different buckets pass as equal with a probability of about 2**-128."""
    shape = a.limit(0).union(b.limit(0)).schema
    names = [f"c{i}" for i in range(len(shape))]     # names may repeat
    a, b = (d.toDF(*names).select(*[F.col(c).cast(f.dataType) for c, f in zip(names, shape.fields)]) for d in (a, b))
    one, two = _row_hashes(a)
    bucket = F.pmod(one, F.lit(buckets)).cast("int")

    def digest(d, sign):
        wide = "decimal(20,0)"
        return d.groupBy(bucket.alias("_bucket")).agg(
            (F.count(F.lit(1)) * sign).alias("n"), (F.sum(one.cast(wide)) * sign).alias("h1"),
            (F.sum(two.cast(wide)) * sign).alias("h2"))

    sums = digest(a, 1).unionByName(digest(b, -1)).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("n", "h1", "h2")])
    # written: one row per bucket at most, read by both sides
    differ = stored(sums.where("n <> 0 OR h1 <> 0 OR h2 <> 0").select("_bucket"), "differing")
    if differ.isEmpty():       # else both tables, with all that they are made from, run again
        return a.sparkSession.createDataFrame([], a.schema.add("side", "string", False)).toDF(*shape.names, "side")

    def suspects(d):
        return d.withColumn("_bucket", bucket).join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket")

    a, b = suspects(a), suspects(b)
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))).toDF(*shape.names, "side"))
