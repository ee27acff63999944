"""Model-side checks: tree attributions add up to Spark's own margin (E14),
isolation forest flags the planted outliers (M10), tracking round trip."""

import pytest
from pyspark.ml.functions import vector_to_array


def _table(spark):
    import random
    rng = random.Random(11)
    rows = []
    for i in range(400):
        a, b, c = rng.random(), rng.randint(0, 5), rng.choice(["x", "y", "z"])
        y = int(a + 0.2 * b + (0.5 if c == "x" else 0) + rng.gauss(0, 0.3) > 1.2)
        rows.append((a, float(b), c, y))
    return spark.createDataFrame(rows, "a double, b double, cat string, came_back int")


def test_tree_attributions_add_up_to_margin(spark):
    from pyspark.ml import Pipeline
    from dosewise.ml.attribution import attribute
    from dosewise.ml.models import gbt_classifier
    from dosewise.ml.prep import feature_stages
    df = _table(spark)
    model = Pipeline(stages=feature_stages(["a", "b"], "cat") + [gbt_classifier(8, 3, 0.1)]).fit(df)
    att = attribute(model, df.limit(40), keep=["a", "b", "cat"])
    raw = model.transform(df.limit(40)).select("a", "b", "cat", (2 * vector_to_array("rawPrediction")[1]).alias("m"))
    j = att.join(raw, ["a", "b", "cat"]).collect()
    assert len(j) >= 40
    for r in j:
        assert r["base_value"] + sum(r["contributions"]) == pytest.approx(r["m"], abs=1e-9)
        assert r["log_odds"] == pytest.approx(r["m"], abs=1e-9)


def test_isolation_forest_flags_outliers(spark):
    import random
    from dosewise.ml.iforest import IsolationForest
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(500)]
    rows += [(1000 + i, 8 + rng.random(), -8 - rng.random()) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    model = IsolationForest(["x", "y"], n_trees=50, sample_size=128, contamination=0.01, seed=3).fit(df)
    out = model.transform(df)
    flagged = {r["id"] for r in out.filter("flagged").collect()}
    assert {1000, 1001, 1002, 1003, 1004} <= flagged
    assert len(flagged) <= 8


def test_tracking_promotes_best_run(spark, tmp_path):
    from dosewise.ml import tracking as TR
    runs, reg = str(tmp_path / "runs"), str(tmp_path / "reg")
    for name, auc in [("a", 0.70), ("b", 0.75), ("c", 0.72)]:
        TR.log_run(spark, runs, name, None, {"p": 1}, {"test_roc_auc": auc}, 3, 100)
    r = TR.promote(spark, runs, reg, "refill-risk").first()
    assert r["run_name"] == "b" and r["version"] == 1
    r2 = TR.promote(spark, runs, reg, "refill-risk").first()
    assert r2["version"] == 2


def test_boosted_trees_grow_as_by_hand(spark):
    """One tree of depth 1 on a table whose best split is known, the served
    stage's scores, and the same after saving and loading."""
    import math

    from dosewise.ml.boosting import Fit, train
    from dosewise.ml.models import served
    from dosewise.ml.tracking import load_model, save_model
    from dosewise.session import ensure_checkpoint_dir
    rows = [(i, float(i % 10), "x" if i % 3 else "y", int(i % 10 > 6)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_idx long, a double, cat string, came_back int")
    trees = train(df, [Fit("m", 1, 0.5, (1,), 1 << 62)], ["a"], "cat", "came_back")["m"]
    p = 0.3
    left, right = 0.5 * 140 * -p / (140 * p * (1 - p) + 1), 0.5 * 60 * (1 - p) / (60 * p * (1 - p) + 1)
    assert trees.feature[0].tolist() == [0, -1, -1] and 6 <= trees.threshold[0, 0] < 7
    assert trees.value[0, 1:].tolist() == pytest.approx([left, right], rel=1e-6)
    model = served(trees)
    got = {r.a: r.p for r in model.transform(df).select("a", vector_to_array("probability")[1].alias("p")).collect()}
    start = math.log(p / (1 - p))
    assert got[6.0] == pytest.approx(1 / (1 + math.exp(-start - left))) and got[7.0] == pytest.approx(1 / (1 + math.exp(-start - right)))
    path = save_model(model, f"{ensure_checkpoint_dir(spark)}/boosted")
    again = load_model(path).transform(df).select("row_idx", vector_to_array("probability")[1].alias("p"))
    first = model.transform(df).select("row_idx", vector_to_array("probability")[1].alias("p"))
    assert again.exceptAll(first).count() == 0
    # an unseen category, a missing number and a missing category are scored, not refused
    odd = spark.createDataFrame([(1, None, "z", 0), (2, 3.0, None, 1)], df.schema)
    assert model.transform(odd).count() == 2


def test_histogram_splits_equal_a_search_over_all_splits():
    import numpy as np

    from dosewise.ml import boosting as B
    r = np.random.default_rng(4)
    width = [7, 2, 2, 64, 5]
    x = np.stack([r.integers(0, w, 500) for w in width], 1).astype(np.int16)
    y = ((x[:, 0] > 3) ^ (x[:, 4] == 2) ^ (r.random(500) < 0.2)).astype(float)
    start, feature, cut, value = B.grow(x, width, y, B.Fit("m", 3, 0.3, (2,), 1 << 62))

    def split(rows, g, h):
        best = (B.LEAST_GAIN, None, None)
        for j in range(5):
            for b in range(width[j]):
                right = x[rows, j] == b if j == 4 else x[rows, j] > b
                gl, hl, gr, hr = g[rows][~right].sum(), h[rows][~right].sum(), g[rows][right].sum(), h[rows][right].sum()
                if min(hl, hr) < B.LEAST_HESSIAN:
                    continue
                gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, j, b)
        return best[1:]

    margin = np.full(500, start)
    for t in range(2):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        stack = [(0, np.arange(500), 0)]
        while stack:
            node, rows, level = stack.pop()
            j, b = split(rows, g, h) if level < 3 else (None, None)
            assert feature[t, node] == (-1 if j is None else j)
            if j is None:
                margin[rows] += value[t, node]
                assert value[t, node] == pytest.approx(0.3 * g[rows].sum() / (h[rows].sum() + 1), abs=1e-6)
                continue
            assert cut[t, node] == b
            right = x[rows, j] == b if j == 4 else x[rows, j] > b
            stack += [(2 * node + 1, rows[~right], level + 1), (2 * node + 2, rows[right], level + 1)]


def test_grouped_auc_equals_one_group_at_a_time(spark):
    import random

    from pyspark.sql import functions as F

    from dosewise.operators.stats import grouped_auc, roc_auc
    r = random.Random(1)
    rows = [(r.choice("ab"), round(r.random(), 2), int(r.random() < 0.4)) for _ in range(3000)] + [("c", 0.5, 1)]
    df = spark.createDataFrame(rows, "g string, score double, label int").repartition(7)
    got = {x.g: x.auc for x in grouped_auc(df, ["g"]).collect()}
    assert got["c"] is None
    for g in "ab":
        assert got[g] == pytest.approx(roc_auc(df.where(F.col("g") == g)).first().auc, abs=1e-12)


def test_concurrent_promotions_get_different_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from dosewise.ml import tracking as TR
    runs, reg = str(tmp_path / "runs"), str(tmp_path / "reg")
    TR.log_run(spark, runs, "a", None, {}, {"test_roc_auc": 0.7}, 3, 100)
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: TR.promote(spark, runs, reg, "m").first()["version"], range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r.version for r in spark.read.parquet(reg).collect()) == [1, 2, 3, 4]
    assert [TR.claim_version(spark, reg, "other") for _ in range(2)] == [1, 2]


def _walked(m, x, stages):
    """Margins row by row, node by node."""
    import numpy as np
    out = []
    for stage in stages:
        margin = np.full(len(x), m.start)
        for f, cut, value in zip(m.feature[:stage], m.threshold[:stage], m.value[:stage]):
            for i, row in enumerate(x):
                node = 0
                while f[node] >= 0:
                    v = row[f[node]]
                    node = 2 * node + 1 + (v == cut[node] if f[node] == len(row) - 1 else v > cut[node])
                margin[i] += value[node]
        out.append(margin)
    return out


def _grown(depth, rounds):
    import numpy as np

    from dosewise.ml import boosting as B
    r = np.random.default_rng(depth)
    width = [40, 2, 9, 6]
    x = np.stack([r.integers(0, w, 600) for w in width], 1).astype(np.int16)
    y = (r.random(600) < 0.2 + 0.5 * (x[:, 0] > 20) * (x[:, 3] == 2)).astype(float)
    start, feature, cut, value = B.grow(x, width, y, B.Fit("m", depth, 0.3, (rounds,), 1 << 62))
    cuts = [np.append(np.sort(r.normal(size=w - 1)), np.inf) for w in width[:3]] + [np.arange(6.0)]
    real = np.zeros(cut.shape)
    for j, c in enumerate(cuts):
        real[feature == j] = c[cut[feature == j]]
    return B.Trees(["a", "b", "c"], "cat", list("vwxyz"), start, feature, real, value), cuts


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 6])
def test_leaf_tables_give_the_margins_of_a_walk(depth):
    import numpy as np
    m, cuts = _grown(depth, 11)
    r = np.random.default_rng(9)
    x = np.concatenate([r.normal(size=(150, 3)), r.integers(-1, 6, (150, 1))], 1)
    x[::9, 0], x[1::9, 1], x[2::9, 0] = np.inf, cuts[1][0], cuts[0][7]
    for got, want in zip(m.margins(x, [4, 11, 30]), _walked(m, x, [4, 11, 30])):
        assert (got == want).all()


def test_packed_scores_give_the_exact_auc(spark, monkeypatch):
    """Many ranges, ties, missing labels, rows outside the blocks, and copies of
    one row index; scores move packed, not as a row per score and model."""
    import numpy as np

    from dosewise.ml import boosting as B
    monkeypatch.setattr(B, "RANGE", 300)
    models = {"p": _grown(3, 8)[0], "q": _grown(6, 8)[0]}
    r = np.random.default_rng(2)
    rows = [(min(i, 2500), float(a), float(b), float(c), "vwxyz?"[k], None if i % 50 == 3 else int(u < 0.4))
            for i, (a, b, c, k, u) in enumerate(zip(*r.normal(size=(3, 4000)).round(1), r.integers(0, 6, 4000), r.random(4000)))]
    df = spark.createDataFrame(rows, "row_idx long, a double, b double, c double, cat string, came_back int")
    blocks, stages = {"p": (500, 2000), "q": (2500, 2501)}, {"p": (3, 8), "q": (8,)}
    held = df.where("came_back is not null")
    bounds = B.score_ranges(held, models, blocks, stages, held.count())
    packed = B.packed_scores(held, models, blocks, stages, bounds, "came_back")
    assert packed.select("model", "part").distinct().count() > 6 and packed.count() < 1000
    got = {(x.model, x.rounds): x.auc for x in B.aucs(df, models, blocks, stages, "came_back").collect()}
    pdf = held.toPandas()
    for name, (lo, hi) in blocks.items():
        mine = pdf[(pdf.row_idx >= lo) & (pdf.row_idx < hi)]
        for stage, margin in zip(stages[name], models[name].margins(models[name].matrix(mine), list(stages[name]))):
            p, n = (margin[(mine.came_back == v).to_numpy()][None] for v in (1, 0))
            want = ((p.T > n).sum() + (p.T == n).sum() / 2) / (p.size * n.size)
            assert got[name, stage] == pytest.approx(want, abs=1e-12)


def test_the_sample_is_the_rows_of_least_hash(spark):
    from pyspark.sql import functions as F

    from dosewise.ml.boosting import first_by_hash
    df = spark.range(50000).withColumnRenamed("id", "row_idx")
    want = {x.row_idx for x in df.orderBy(F.xxhash64("row_idx"), "row_idx").limit(200).collect()}
    assert {x.row_idx for x in first_by_hash(df, 200).collect()} == want
    # one index on all rows: no hash bounds them, all are sorted
    assert first_by_hash(df.select(F.lit(7).cast("long").alias("row_idx")), 200).count() == 200


def test_the_time_index_is_read_from_files(spark):
    """Later reads of an indexed table prune columns (before: a checkpoint of all)."""
    from dosewise.operators.stats import global_index
    df = spark.range(1000).selectExpr("id % 97 as a", "id as b", "cast(id as string) as c").repartition(5)
    idx = global_index(df, ["a", "b"])
    plan = idx.select("row_idx")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "c#" not in plan
    assert [r.row_idx for r in idx.orderBy("a", "b").collect()] == list(range(1000))


def test_sweep_in_step_equals_fits_one_by_one(spark):
    """Same centres and cost as Spark's own fits, with far fewer jobs."""
    import numpy as np
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.linalg import Vectors

    from dosewise.ml import models as MD
    from dosewise.session import stored
    r = np.random.default_rng(3)
    rows = [(i, Vectors.dense(r.normal(size=3) + 3 * r.integers(0, 3, 3))) for i in range(3000)]
    df = stored(spark.createDataFrame(rows, ["id", "features"]).repartition(4), "points")
    fits = {(k, s): KMeans(k=k, seed=42 + s, maxIter=300, predictionCol="segment").fit(df) for k in (2, 5) for s in range(3)}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sweep-steps", "")
    starts = {t: np.array(KMeans(k=t[0], seed=42 + t[1], maxIter=0).fit(df).clusterCenters()) for t in fits}
    spark.sparkContext.setJobGroup("lloyd-steps", "")
    centres, costs = MD.lloyd(df, starts)
    steps = len(tracker.getJobIdsForGroup("lloyd-steps"))
    spark.sparkContext.setJobGroup("", "")
    assert steps <= 2 + max(m.summary.numIter for m in fits.values()) < sum(m.summary.numIter for m in fits.values())
    for t, m in fits.items():
        assert np.array(m.clusterCenters()) == pytest.approx(centres[t], abs=1e-9)
        assert m.summary.trainingCost == pytest.approx(costs[t], rel=1e-9)
    rows, models = MD.kmeans_sweep(df, ks=[2, 5], restarts=3)
    for k in (2, 5):
        best = min((fits[k, s] for s in range(3)), key=lambda m: m.summary.trainingCost)
        assert np.array(models[k].clusterCenters()) == pytest.approx(np.array(best.clusterCenters()), abs=1e-9)
        a = best.transform(df).select("id", "segment")
        assert a.exceptAll(models[k].transform(df).select("id", "segment")).count() == 0


def test_every_training_row_counts(spark):
    """Before, a model was fitted on at most 2**18 rows."""
    import math

    from dosewise.ml.boosting import Fit, train
    df = spark.range(280_000).selectExpr("id as row_idx", "cast(id % 5 as double) as a", "if(id % 3 = 0, 'x', 'y') as cat",
                                         "cast(id % 11 = 0 as int) as came_back")
    got = train(df, [Fit("all", 1, 0.5, (1,), 1 << 62), Fit("fold", 1, 0.5, (1,), 270_001)], ["a"], "cat", "came_back")
    for name, n, ones in (("all", 280_000, 25_455), ("fold", 270_001, 24_546)):
        assert got[name].start == pytest.approx(math.log(ones / (n - ones)), abs=1e-12)


def test_models_grown_in_step_equal_models_grown_alone(spark, monkeypatch):
    """Rows in blocks and one job per level, folds of several lengths, missing
    numbers, categories and labels, and equal rows."""
    import numpy as np

    from dosewise.ml import boosting as B
    r = np.random.default_rng(5)
    a, b, c = r.normal(size=4000).round(1), r.integers(0, 4, 4000), r.integers(0, 5, 4000)
    y = r.random(4000) < 0.2 + 0.4 * (a > 0.5) * (c == 2) + 0.2 * (b > 1)
    rows = [(i, None if i % 90 == 1 else float(a[i]), float(b[i]), None if i % 70 == 2 else "vwxyz"[c[i]], None if i % 50 == 3 else int(y[i]))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "row_idx long, a double, b double, cat string, came_back int").repartition(3)
    fits = [B.Fit("s", 3, 0.1, (4, 9), 700), B.Fit("t", 3, 0.1, (9,), 4000), B.Fit("u", 6, 0.3, (6,), 2500), B.Fit("none", 2, 0.1, (2,), 0)]
    alone = B.train(df, fits, ["a", "b"], "cat", "came_back")
    for name, value in (("FEW", 300), ("PART", 100), ("KEEP", 3), ("DIRECT", 2)):
        monkeypatch.setattr(B, name, value)
    step = B.train(df, fits, ["a", "b"], "cat", "came_back", held=10)
    for f in fits:
        x, z = alone[f.name], step[f.name]
        assert x.start == z.start and x.feature.shape[0] == max(f.stages)
        assert (x.feature == z.feature).all() and (x.threshold == z.threshold).all()
        assert np.abs(x.value - z.value).max() < 1e-5
