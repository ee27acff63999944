"""Table equality by digests, samples that merge, the Euclidean silhouette and
the layout by month and key."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dosewise.ml import models as MD
from dosewise.operators import relational as R
from dosewise.sources import tables as S


def _multiset(rows):
    return collections.Counter(tuple(r) for r in rows)


def _diff(spark, a, b, schema="k long, s string"):
    d = R.table_diff(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()
    return (_multiset(r[:-1] for r in d if r["side"] == "left_only"), _multiset(r[:-1] for r in d if r["side"] == "right_only"))


def test_table_diff_is_the_multiset_difference(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b"])) for _ in range(600)]
    other = [r for r in rows if rng.random() < 0.9] + rows[:40] + [(None, "new")]
    left, right = _diff(spark, rows, other)
    assert left == _multiset(rows) - _multiset(other)
    assert right == _multiset(other) - _multiset(rows)


@pytest.mark.parametrize("a,b", [([(1, None)], [(None, "1")]), ([(1, "x")], [(1, "x"), (1, "x")]), ([], [(1, "x")]),
                                 ([(None, None)], [])])
def test_table_diff_tells_missing_and_repeated_rows(spark, a, b):
    left, right = _diff(spark, a, b)
    assert left == _multiset(a) - _multiset(b) and right == _multiset(b) - _multiset(a)


def test_table_diff_of_equal_tables_compares_no_row(spark):
    a = spark.range(5000).select("id", F.col("id").cast("string").alias("id"))     # names may repeat
    d = R.table_diff(a, a.repartition(7))
    assert d.columns == ["id", "id", "side"] and d.count() == 0
    # types are matched as a union would match them
    assert R.table_diff(spark.range(9).selectExpr("cast(id as int) id"), spark.range(9)).count() == 0


def test_sample_is_the_same_for_any_partitioning_and_merges(spark):
    df = spark.range(3000).withColumn("g", F.col("id") % 3)
    one = {r["id"] for r in R.sample_n(df, ["id"], 50).collect()}
    assert one == {r["id"] for r in R.sample_n(df.repartition(11), ["id"], 50).collect()} and len(one) == 50
    halves = [R.sample_n(df.where(c), ["id"], 50) for c in ("id < 1000", "id >= 1000")]
    assert one == {r["id"] for r in R.sample_n(halves[0].unionAll(halves[1]), ["id"], 50).collect()}
    per = R.sample_n(df, ["id"], 20, by=["g"])
    assert {r["count"] for r in per.groupBy("g").count().collect()} == {20}
    assert "WindowGroupLimit" in per._jdf.queryExecution().executedPlan().toString()    # each task keeps 20 of a group
    assert R.sample_n(df, ["id"], 9999).count() == 3000 and R.sample_n(df.limit(0), ["id"], 5).count() == 0


def _brute(points):
    out = {}
    for k, lab, *x in points:
        dist = collections.defaultdict(list)
        for j, other, *y in points:
            if j != k:
                dist[other].append(float(np.linalg.norm(np.subtract(x, y))))
        if not dist[lab]:
            out[k] = 0.0
            continue
        own, rest = np.mean(dist[lab]), min(np.mean(v) for m, v in dist.items() if m != lab and v)
        out[k] = (rest - own) / max(own, rest)
    return out


def test_silhouette_equals_all_distances(spark):
    rng = np.random.default_rng(5)
    pts = [(i, f"c{i % 3}", *map(float, rng.normal(i % 3, 0.7, 2))) for i in range(90)] + [(90, "alone", 9.0, 9.0)]
    df = spark.createDataFrame(pts + [(91, None, 0.0, 0.0), (92, "c1", None, 1.0)], "k long, label string, x double, y double")
    got = {r["k"]: r["silhouette"] for r in MD.silhouette_rows(df, ["x", "y"], "label", ["k"]).collect()}
    want = _brute(pts)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert MD.silhouette_rows(df, ["x", "y"], "label", ["k"], n=30).count() == 30
    one = MD.silhouette_rows(df.where("label = 'c0'"), ["x", "y"], "label", ["k"]).collect()
    assert one and all(r["silhouette"] is None for r in one)
    assert MD.silhouette_rows(df.limit(0), ["x", "y"], "label", ["k"]).count() == 0


def test_silhouette_of_equal_points_is_zero(spark):
    df = spark.createDataFrame([(i, i % 2, 1.0) for i in range(8)], "k long, label long, x double")
    assert {r["silhouette"] for r in MD.silhouette_rows(df, ["x"], "label", ["k"]).collect()} == {0.0}


def test_layout_reads_only_the_folders_of_the_months(spark, tmp_path):
    df = spark.range(4000).select(F.col("id").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 365).cast("int"))
                                  .alias("day")).unionAll(spark.createDataFrame([(-1, None)], "k long, day date"))
    path = str(tmp_path / "t")
    S.write_pruned(df, path, "day", "k")
    got = S.read_pruned(spark, path, df.schema, "day", "2020-03-10", "2020-05-01").where("k < 900")
    want = df.where("day >= '2020-03-10' and day < '2020-05-01' and k < 900")
    assert got.columns == df.columns and _multiset(got.collect()) == _multiset(want.collect())
    scan = got._jdf.queryExecution().sparkPlan()
    while scan.children().size():
        scan = scan.children().head()
    read = scan.selectedPartitions().totalNumberOfFiles()
    months = {f"{m:02d}": len(list((tmp_path / "t" / f"month=2020-{m:02d}").glob("*.parquet"))) for m in (3, 4, 5)}
    whole = len(list((tmp_path / "t").glob("*/*.parquet")))
    assert read == sum(months.values()) < whole / 2
    assert re.search(r"PushedFilters: \[.*k", got._jdf.queryExecution().executedPlan().toString())


def test_equal_tables_are_not_read_again(spark):
    """Once the digests agree nothing is left to run; before, both tables ran again."""
    from dosewise.operators import relational as R
    a = spark.range(500).selectExpr("id", "cast(id % 7 as string) as id")
    d = R.table_diff(a, a.repartition(7))
    assert d.columns == ["id", "id", "side"] and d.count() == 0
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Range" not in plan
