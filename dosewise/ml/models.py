"""Model fits (M1-M9, M11-M13, E9-E11, E13) as Spark ML pipelines.

Defaults are the reference's settings.  Every fit returns a ``PipelineModel``
whose stages hold the feature order, so saving and loading keeps features and
model together (S9).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.functions.scalars import row_mse
from dosewise.ml import gradient, logistic
from dosewise.ml.boosting import BoostedTrees, Fit
from dosewise.ml.boosting import train as boost
from dosewise.ml.prep import NUMERIC_FEATURES, feature_stages, one_hot_stages
from dosewise.operators.relational import sample_n
from dosewise.session import ensure_checkpoint_dir, few_tasks, ship_package, stored

LABEL = "came_back"


@dataclass
class LogisticRows:
    """Training rows prepared once for both logistic fits: the fitted one-hot stages
    and the rows in packed form."""
    first: list
    rows: logistic.Packed


def logistic_rows(train: DataFrame, label: str = LABEL) -> LogisticRows:
    first = Pipeline(stages=one_hot_stages()).fit(train).stages
    code = first[0].getOutputCol()
    return LogisticRows(first, logistic.packed(first[0].transform(train), NUMERIC_FEATURES, code, label, len(first[0].labels)))


def _logistic(n: int, label: str, max_iter: int) -> LogisticRegression:
    """regParam = 1/n with standardization off is the same objective as C = 1."""
    return LogisticRegression(labelCol=label, maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)


def fit_logistic(train: DataFrame, label: str = LABEL, max_iter: int = 1000, shared: LogisticRows | None = None) -> PipelineModel:
    """M1: L2 logistic regression on unscaled features, fitted by ``ml.logistic``.
    Rows with missing numbers and labels of one kind are left to Spark's fit."""
    own = shared or logistic_rows(train, label)
    at = own.rows.at
    if not at.usable:
        return Pipeline(stages=feature_stages() + [_logistic(train.count(), label, max_iter)]).fit(train)
    b, w = logistic.fit(own.rows, np.ones(len(at.mean)), max_iter)
    if shared is None:
        own.rows.release()
    return PipelineModel([*own.first, feature_stages()[-1], _regression(train, _logistic(at.n, label, max_iter), b, w)])


def fit_scaled_logistic(train: DataFrame, label: str = LABEL, max_iter: int = 1000,
                        shared: LogisticRows | None = None) -> PipelineModel:
    """M2: scaler + logistic regression in one pipeline.  Spark's scaler divides
    by the sample deviation; the factor after it makes that the population's."""
    own = shared or logistic_rows(train, label)
    at = own.rows.at
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)

    def factor(n, width):
        return ElementwiseProduct(inputCol="scaled", outputCol="features", scalingVec=Vectors.dense([(n / max(n - 1, 1)) ** 0.5] * width))

    if not at.usable:
        n = train.count()
        first = Pipeline(stages=feature_stages(out="raw")).fit(train)
        width = first.transform(train).select(F.size(vector_to_array("raw"))).first()[0]
        return Pipeline(stages=[first, scaler, factor(n, width), _logistic(n, label, max_iter)]).fit(train)
    # a penalty on the weights of standardised columns is one of sd**2 on those of the columns
    b, w = logistic.fit(own.rows, at.sd ** 2, max_iter)
    if shared is None:
        own.rows.release()
    two = _two_rows(train, len(w), "raw", label)
    scaled = _with_data(scaler.fit(two), two.sparkSession, {
        "std": Vectors.dense(at.sd * (at.n / (at.n - 1)) ** 0.5), "mean": Vectors.dense(at.mean)})
    return PipelineModel([PipelineModel([*own.first, feature_stages(out="raw")[-1]]), scaled, factor(at.n, len(w)),
                          _regression(train, _logistic(at.n, label, max_iter), b + w @ at.mean, w * at.sd)])


def _two_rows(df: DataFrame, width: int, features: str, label: str) -> DataFrame:
    """A table of two rows, on which Spark makes a model's saved form."""
    return df.sparkSession.createDataFrame([(Vectors.sparse(width, [], []), 0.0), (Vectors.sparse(width, [0], [1.0]), 1.0)],
                                           [features, label]).coalesce(1)


def _regression(df: DataFrame, estimator: LogisticRegression, intercept: float, weights: np.ndarray) -> LogisticRegressionModel:
    """``estimator``'s model with these weights."""
    shape = estimator.copy({estimator.maxIter: 1}).fit(_two_rows(df, len(weights), estimator.getFeaturesCol(), estimator.getLabelCol()))
    shape.set(shape.maxIter, estimator.getMaxIter())
    return _with_data(shape, df.sparkSession, {"interceptVector": Vectors.dense([intercept]),
                                               "coefficientMatrix": DenseMatrix(1, len(weights), weights, True)})


def _with_data(model, spark, values: dict):
    """``model`` with other numbers: its saved form with ``values`` in their place."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path + "/shape")
    data = spark.read.parquet(path + "/shape/data")
    row = data.first().asDict() | values
    spark.read.text(path + "/shape/metadata").coalesce(1).write.text(path + "/model/metadata")
    spark.createDataFrame([tuple(row[c] for c in data.columns)], data.schema).coalesce(1).write.parquet(path + "/model/data")
    return type(model).load(path + "/model")


def gbt_classifier(max_iter: int = 300, max_depth: int = 4, step: float = 0.05, label: str = LABEL,
                   features: str = "features"):
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, seed=42, cacheNodeIds=True, checkpointInterval=10)


def gbt_pipeline(max_iter: int = 300, max_depth: int = 4, step: float = 0.05, label: str = LABEL) -> Pipeline:
    return Pipeline(stages=feature_stages() + [gbt_classifier(max_iter, max_depth, step, label)])


def fit_gbt(train: DataFrame, max_iter: int = 300, max_depth: int = 4, step: float = 0.05,
            label: str = LABEL) -> PipelineModel:
    """M3/M4: boosted trees (guessed 300/4/0.05, tuned 200/3/0.03)."""
    first = Pipeline(stages=feature_stages()).fit(train)
    return PipelineModel([*first.stages, gradient.fit(first.transform(train), gbt_classifier(max_iter, max_depth, step, label))])


def fit_boosted(train: DataFrame, settings: dict[str, tuple[int, int, float]], label: str = LABEL) -> dict[str, PipelineModel]:
    """Named boosted-tree models (max_iter, max_depth, step) of the learner that
    searches rank (``ml.boosting``), fitted together on all rows."""
    indexed = stored(train.select(*NUMERIC_FEATURES, "drug_name", label).withColumn("row_idx", F.monotonically_increasing_id()),
                     "to-boost")
    fits = [Fit(name, depth, step, (rounds,), 1 << 62) for name, (rounds, depth, step) in settings.items()]
    found = boost(indexed, fits, NUMERIC_FEATURES, "drug_name", label)
    return {name: served(t) for name, t in found.items()}


def served(trees) -> PipelineModel:
    """Fitted trees as a pipeline that can be saved and loaded."""
    return PipelineModel([BoostedTrees(trees=trees.to_json())])


def scores(model: PipelineModel, df: DataFrame, label: str = LABEL, keep=()) -> DataFrame:
    """Positive-class probability and label of every row."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias("score"), F.col(label).alias("label"))


DEMAND_NUMERIC = ["units", "lag_1", "lag_7", "lag_14", "lag_28", "roll7", "roll28", "dow", "month"]


def fit_demand(train: DataFrame, max_iter: int = 400, max_depth: int = 4, step: float = 0.05) -> PipelineModel:
    """M5: boosted-tree regressor of the 7-day target, drug one-hot."""
    stages = feature_stages(DEMAND_NUMERIC, "drug_id") + [
        GBTRegressor(labelCol="target", maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=42,
                     cacheNodeIds=True, checkpointInterval=10)]
    return Pipeline(stages=stages).fit(few_tasks(train))


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """Importance per input feature (Spark's normalised gain x count),
    one-hot slots named after their category."""
    tree = model.stages[-1]
    names = _feature_names(model)
    imp = tree.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")


def _feature_names(model: PipelineModel) -> list[str]:
    """Expanded feature names in vector order, from the fitted stages."""
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler as VA
    labels, inputs = {}, []
    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            labels[st.getOutputCol().replace("_idx", "_vec")] = (st.getInputCol(), st.labels)
        if isinstance(st, VA):
            inputs = st.getInputCols()
    names = []
    for c in inputs:
        if c in labels:
            base, labs = labels[c]
            names += [f"{base}_{x}" for x in labs]
        else:
            names.append(c)
    return names


# --- clustering and projection -------------------------------------------------------

def silhouette_rows(df: DataFrame, features: list[str], label: str, key: list[str], n: int = 2000, seed: int = 42) -> DataFrame:
    """Euclidean silhouette of each row of a seeded sample of ``n`` rows:
    the key, the label, ``own`` (mean distance to the other sampled rows of its
    cluster), ``other`` (the least mean distance to another cluster) and
    ``silhouette`` = (other - own) / max of both.

    Distances are needed inside the sample only, and ``n`` bounds it: every task
    holds the sample and sums, for its block of rows, the distances per cluster.
    A row alone in its cluster has 0; with one cluster, own and all, it is null.
    Rows with a missing feature or label are left out before sampling."""
    rows = sample_n(df.select(*key, label, *[F.col(c).cast("double").alias(c) for c in features]).dropna(
        "any", subset=[label, *features]), key, n, seed)
    rows = stored(rows, "silhouette")
    held = rows.select(label, *features).collect()     # at most n rows
    x = np.array([r[1:] for r in held], float).reshape(len(held), len(features))
    names = sorted({r[0] for r in held})
    where = {v: i for i, v in enumerate(names)}
    hot = np.zeros((len(held), len(names)))
    hot[np.arange(len(held)), [where[r[0]] for r in held]] = 1
    size = hot.sum(axis=0)

    def run(batches):
        for pdf in batches:
            q = pdf[features].to_numpy(float)
            sums = np.zeros((len(q), len(names)))
            for at in range(0, len(q), 256):
                block = q[at:at + 256]
                sums[at:at + 256] = np.sqrt(((block[:, None, :] - x[None]) ** 2).sum(axis=2)) @ hot
            mine = pdf[label].map(where).to_numpy(int)
            i = np.arange(len(q))
            own = sums[i, mine] / np.maximum(size[mine] - 1, 1)
            means = sums / size
            means[i, mine] = np.inf
            other = means.min(axis=1) if len(names) > 1 else np.full(len(q), np.nan)
            most = np.maximum(own, other)
            s = np.where((size[mine] == 1) | (most == 0), 0.0, (other - own) / np.where(most == 0, 1, most))
            if len(names) < 2:
                s[:] = np.nan
            out = pdf[[*key, label]].copy()
            out["own"], out["other"], out["silhouette"] = own, other, s
            yield out

    shape = T.StructType([*[rows.schema[c] for c in (*key, label)],
                          *[T.StructField(c, T.DoubleType()) for c in ("own", "other", "silhouette")]])
    done = rows.repartition(min(16, -(-n // 256)), *key).mapInPandas(run, shape)
    return done.select(*key, label, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("own", "other", "silhouette")])


def cluster_summary(df: DataFrame, by: str, cols: list[str], digits: int = 2) -> DataFrame:
    """Size and means per segment, rounded half to even."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("patients"), *[F.bround(F.avg(c), digits).alias(c) for c in cols])


def kmeans_sweep(df: DataFrame, ks=range(2, 8), restarts: int = 10, features: str = "features",
                 parallelism: int = 4) -> tuple[list[dict], dict]:
    """For each k the best of ``restarts`` seeded fits (lowest
    cost, then lowest seed), its inertia and silhouette (Spark's
    squared-Euclidean form, on the whole table).  Spark's ``KMeans`` gives every
    fit its seeded starts, side by side; then all fits move their centres in step
    (``lloyd``), a job per step over all rows.  Returns (rows, {k: model})."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="segment")
    rows, models = [], {}

    def start(at):
        k, s = at
        return KMeans(k=k, seed=42 + s, maxIter=0, featuresCol=features, predictionCol="segment").fit(df)

    tries = list(product(ks, range(restarts)))
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        starts = dict(zip(tries, pool.map(start, tries)))
    centres, costs = lloyd(df, {t: np.array(m.clusterCenters()) for t, m in starts.items()}, features)
    for k in ks:
        s = min(range(restarts), key=lambda s: costs[k, s])
        best = with_centres(starts[k, s], centres[k, s], df.sparkSession)
        sil = ev.evaluate(best.transform(df))
        rows.append({"k": k, "inertia": inertia(df, best, features), "silhouette": float(sil)})
        models[k] = best
    return rows, models


def lloyd(df: DataFrame, starts: dict, features: str = "features", most: int = 300, tol: float = 1e-4) -> tuple[dict, dict]:
    """k-means steps of several fits over the same rows: (centres, costs) by fit.
    A fit stops as Spark's does, when no centre moves by more than ``tol`` or after
    ``most`` steps; its cost is that of the centres before the last move.

    The rows stay in the executors as blocks of numbers; a step is one job whose
    sums (counts, sums and cost per centre of the fits that still move) do not
    depend on the rows."""
    spark = df.sparkSession
    ship_package(spark)
    width = len(next(iter(starts.values()))[0])

    def pack(batches):
        for b in batches:
            if len(b):
                x = b.column(0).flatten().to_numpy(zero_copy_only=False)
                yield pa.record_batch([pa.array([x.tobytes()], pa.binary())], names=["x"])

    blocks = df.select(vector_to_array(features).alias("x")).mapInArrow(pack, "x binary").rdd.map(
        lambda r: np.frombuffer(r.x).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)
    branches = max(2, round(blocks.getNumPartitions() ** (1 / 3)))
    centres, costs, moving = dict(starts), dict.fromkeys(starts, 0.0), sorted(starts)
    for _ in range(most):
        now = [centres[t] for t in moving]

        def sums(part, now=now):
            out = [[np.zeros(len(c)), np.zeros_like(c), np.zeros(1)] for c in now]
            for block in part:
                for at in range(0, len(block), 1 << 11):
                    _step(block[at:at + (1 << 11)], now, out)
            return [[a for o in out for a in o]]

        got = gradient.added(blocks.mapPartitions(sums), branches)
        still = []
        for i, t in enumerate(moving):
            n, total, cost = got[3 * i:3 * i + 3]
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[t])
            if (((new - centres[t]) ** 2).sum(axis=1) > tol * tol).any():
                still.append(t)
            centres[t], costs[t] = new, float(cost[0])
        moving = still
        if not moving:
            break
    blocks.unpersist()
    return centres, costs


def _step(x: np.ndarray, fits: list[np.ndarray], out: list) -> None:
    """Add the rows' counts, sums and costs at each fit's nearest centres."""
    whole = np.concatenate(fits)
    far = (whole ** 2).sum(axis=1)[:, None] - 2 * (whole @ x.T)      # less |x|^2, the same for all centres
    square, at = (x ** 2).sum(axis=1), 0
    for c, (n, total, cost) in zip(fits, out):
        mine = far[at:at + len(c)]
        near = mine.argmin(axis=0)
        n += np.bincount(near, minlength=len(c))
        total += (near == np.arange(len(c))[:, None]).astype(float) @ x
        cost += np.maximum(mine.min(axis=0) + square, 0).sum()
        at += len(c)


def with_centres(model: KMeansModel, centres: np.ndarray, spark) -> KMeansModel:
    """``model`` with other centres: its saved form with theirs in their place."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/segments-{uuid.uuid4().hex}"
    model.write().save(path + "/shape")
    shape = spark.read.parquet(path + "/shape/data").schema
    spark.read.text(path + "/shape/metadata").coalesce(1).write.text(path + "/model/metadata")
    spark.createDataFrame([(j, Vectors.dense(c)) for j, c in enumerate(centres)], shape).coalesce(1).write.parquet(path + "/model/data")
    return KMeansModel.load(path + "/model")


def inertia(df: DataFrame, model, features: str = "features") -> float:
    """Sum of squared distances to the nearest of the final centres (the
    model's own figure is that of the centres before the last move)."""
    x = vector_to_array(features)
    d = [sum(((x[j] - float(c[j])) ** 2 for j in range(len(c))), F.lit(0.0)) for c in model.clusterCenters()]
    return float(df.agg(F.sum(F.array_min(F.array(*d)))).first()[0])


def standardized_vector(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """D10 as a vector column: population-std z-scores of ``cols``."""
    from dosewise.ml.prep import standardize
    z = standardize(df, cols, suffix="_z")
    return VectorAssembler(inputCols=[c + "_z" for c in cols], outputCol=out).transform(z)


def project_2d(df: DataFrame, features: str = "features"):
    """2-component PCA of standardised (centred) features; returns
    (coordinates table, explained variance shares)."""
    m = PCA(k=2, inputCol=features, outputCol="pc").fit(df)
    out = m.transform(df).withColumn("_pc", vector_to_array("pc"))
    return (out.select("*", F.col("_pc")[0].alias("pc1"), F.col("_pc")[1].alias("pc2")).drop("_pc", "pc"),
            m.explainedVariance.toArray().tolist())


def rebuild_error(df: DataFrame, features: str = "features", k: int = 2) -> DataFrame:
    """Squeeze to k principal components and rebuild; the mean
    squared rebuild error is the oddness (the re-aimed autoencoder)."""
    m = PCA(k=k, inputCol=features, outputCol="_pc").fit(df)
    comps = m.pc.toArray()               # d x k, a bounded matrix
    d = comps.shape[0]
    t = m.transform(df).withColumn("_p", vector_to_array("_pc")).withColumn("_x", vector_to_array(features))
    rebuilt = F.array(*[sum((F.col("_p")[j] * F.lit(float(comps[i, j])) for j in range(k)), F.lit(0.0))
                        for i in range(d)])
    return t.withColumn("error", row_mse("_x", rebuilt)).drop("_p", "_x", "_pc")


# --- sequence models (re-aimed from the recurrent networks) ------------------------------

def fit_window_demand(train: DataFrame, max_iter: int = 400, max_depth: int = 4, step: float = 0.05) -> PipelineModel:
    """Boosted trees on the 28 scaled values of each window."""
    reg = GBTRegressor(labelCol="target", featuresCol="features", maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step, seed=42, cacheNodeIds=True, checkpointInterval=10)
    return Pipeline(stages=[reg]).fit(few_tasks(train.withColumn("features", array_to_vector("window"))))


def fit_sequence(train: DataFrame, kind: str = "raw", max_iter: int = 200, max_depth: int = 3,
                 step: float = 0.03) -> PipelineModel:
    """Refill models on the last 6 gap ratios: ``raw`` (the 6 values),
    ``summary`` (mean, std, last, share over 1.4) with boosted trees, or
    ``mlp`` (order-aware perceptron 6-16-2)."""
    if kind == "summary":
        df = train.withColumn("features", array_to_vector(F.array("w_mean", "w_std", "w_last", "w_share_over")))
    else:
        df = train.withColumn("features", array_to_vector("window"))
    if kind == "mlp":
        est = MultilayerPerceptronClassifier(labelCol="came_back", layers=[6, 16, 2], seed=42, maxIter=200)
        return Pipeline(stages=[est]).fit(few_tasks(df))
    return PipelineModel([gradient.fit(df, gbt_classifier(max_iter, max_depth, step))])
