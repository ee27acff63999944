"""Isolation forest (M10) as a Spark estimator.

Fit:
1. A Bernoulli sample of about 1.5 x trees x sample_size rows (bounded,
   independent of the table size) is drawn with a seed.
2. Each sampled row joins tree t when a hash of (row, t) falls under
   sample_size / pool_size, so every tree sees a uniform subsample of about
   ``sample_size`` rows.  Rows are exploded only into the trees they join.
3. ``groupBy(tree).applyInPandas`` grows one random isolation tree per group
   on the executors (numpy), emitting its nodes.
4. The forest (trees x (2 x sample_size - 1) nodes at most) is the only
   thing brought to the driver, and is shipped to the scoring tasks.

Score: ``mapInPandas`` walks every tree for a batch of rows at once
(vectorised numpy), giving the anomaly score -2^(-E[h(x)] / c(n)).  The
decision offset is the ``contamination`` quantile of the training scores,
computed with the exact distributed quantile; lower = odder, flagged when
score < offset.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.operators.stats import exact_quantiles
from dosewise.session import stored

EULER = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
])


def avg_path(n):
    """Average path length of an unsuccessful search in a binary search tree
    of n points (0 for n <= 1, 1 for n = 2)."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grower(features: list[str], max_depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100_003 + tree)
        rows = []

        def build(idx, depth):
            me = len(rows)
            rows.append([tree, me, -1, 0.0, -1, -1, len(idx)])
            if depth >= max_depth or len(idx) <= 1:
                return me
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if len(cand) == 0:
                return me
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < thr
            left = build(idx[go_left], depth + 1)
            right = build(idx[~go_left], depth + 1)
            rows[me][2:6] = [f, thr, left, right]
            return me

        build(np.arange(len(X)), 0)
        return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])
    return grow


class IsolationForestModel:
    def __init__(self, nodes: pd.DataFrame, features: list[str], sample_size: int, contamination: float):
        self.features = features
        self.sample_size = sample_size
        self.contamination = contamination
        self.trees = []
        for _, g in nodes.groupby("tree"):
            g = g.sort_values("node")
            self.trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                               g["right"].to_numpy(), g["size"].to_numpy()))

    def _scorer(self):
        trees, feats, norm = self.trees, self.features, float(avg_path([self.sample_size])[0])

        def score(it):
            for pdf in it:
                X = pdf[feats].to_numpy(dtype=float)
                total = np.zeros(len(X))
                for feat, thr, left, right, size in trees:
                    node = np.zeros(len(X), dtype=int)
                    depth = np.zeros(len(X))
                    active = feat[node] >= 0
                    while active.any():
                        f = feat[node[active]]
                        go_left = X[active, f] < thr[node[active]]
                        node[active] = np.where(go_left, left[node[active]], right[node[active]])
                        depth[active] += 1
                        active = feat[node] >= 0
                    total += depth + avg_path(size[node])
                pdf = pdf.copy()
                pdf["anomaly_score"] = -np.power(2.0, -(total / len(trees)) / norm)
                yield pdf
        return score

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (higher = more normal, like the reference's
        score_samples)."""
        schema = T.StructType(df.schema.fields + [T.StructField("anomaly_score", T.DoubleType())])
        return df.mapInPandas(self._scorer(), schema)

    def transform(self, df: DataFrame, train: DataFrame | None = None) -> DataFrame:
        """Add ``oddness`` (score - offset; below 0 = flagged) and ``flagged``.
        The offset is the contamination quantile of the training scores."""
        s = stored(self.score(df), "oddness")   # scored once, read for the offset and the result
        base = s if train is None else self.score(train)
        q = exact_quantiles(base.withColumn("_g", F.lit(0)), ["_g"], "anomaly_score", [self.contamination])
        offset = q.select(F.col("quantiles")[0]).scalar()
        s = s.withColumn("oddness", F.col("anomaly_score") - offset)
        return s.withColumn("flagged", F.col("oddness") < 0)


class IsolationForest:
    def __init__(self, features: list[str], n_trees: int = 100, sample_size: int = 256,
                 contamination: float = 0.05, seed: int = 42):
        self.features, self.n_trees, self.sample_size = features, n_trees, sample_size
        self.contamination, self.seed = contamination, seed

    def fit(self, df: DataFrame) -> IsolationForestModel:
        n = df.count()
        psi = min(self.sample_size, n)
        frac = min(1.0, 1.5 * psi * self.n_trees / max(n, 1))
        pool = df.select(*self.features).sample(fraction=frac, seed=self.seed) if frac < 1.0 \
            else df.select(*self.features)
        pool = pool.withColumn("_rid", F.monotonically_increasing_id())
        m = pool.count()
        p = min(1.0, psi / max(m, 1))
        u = lambda i: (F.abs(F.xxhash64(F.col("_rid"), i, F.lit(self.seed))) % 1_000_000) / 1e6
        member = pool.withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(self.n_trees - 1)),
                                                           lambda i: u(i) < p)))
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        nodes = (member.groupBy("tree").applyInPandas(_grower(self.features, max_depth, self.seed), NODE_SCHEMA)
                 .toPandas())
        return IsolationForestModel(nodes, self.features, psi, self.contamination)
