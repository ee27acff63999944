"""Boosted trees summed over all rows: Spark's own trees on a table whose edges
are exact, whatever the number of tasks."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array


def _rows(n):
    rng = random.Random(7)
    out = []
    for i in range(n):
        a, b, c = rng.random(), float(rng.randint(0, 50)), rng.choice("wxyz")
        out.append((i, a, b, c, int(a + b / 50 + (0.5 if c == "x" else 0) + rng.gauss(0, 0.4) > 1.2)))
    return out


@pytest.mark.parametrize("few", [1 << 16, 500])
def test_same_trees_as_spark(spark, monkeypatch, few):
    from dosewise.ml import gradient
    from dosewise.ml.models import gbt_classifier
    from dosewise.ml.prep import feature_stages
    monkeypatch.setattr(gradient, "FEW", few)
    monkeypatch.setattr(gradient, "KEEP", 5)
    df = spark.createDataFrame(_rows(3000), "i int, a double, b double, cat string, came_back int").repartition(3)
    first = Pipeline(stages=feature_stages(["a", "b"], "cat")).fit(df)
    x = first.transform(df)
    est = gbt_classifier(12, 3, 0.1)
    theirs, mine = est.fit(x), gradient.fit(x, est)
    assert mine.getNumTrees == 12 and mine.getMaxIter() == 12
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)

    def scores(m):
        return {r.i: r.p for r in m.transform(x).select("i", vector_to_array("probability")[1].alias("p")).collect()}
    assert scores(mine) == pytest.approx(scores(theirs), abs=1e-9)


def test_edges_of_large_tables_keep_rare_values(spark, monkeypatch):
    from dosewise.ml import gradient
    monkeypatch.setattr(gradient, "EXACT", 10)
    rows = spark.createDataFrame([([0.0 if i else 1.0, 1.0 if i else 0.0, float(i)],) for i in range(2000)], "x array<double>")
    rare, common, many = gradient.edges(rows, 3, 2000)
    assert list(rare) == [0.0] and list(common) == [0.0] and 25 <= len(many) <= 32


def test_many_rounds_are_not_sparks_own(spark, monkeypatch):
    """Before, every round was a handful of jobs over wide rows."""
    from pyspark.ml.classification import GBTClassifier
    from dosewise.ml import models as MD
    from dosewise.ml.prep import NUMERIC_FEATURES
    rounds, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: rounds.append(self.getMaxIter()) or fit(self, df))
    rng = random.Random(3)
    rows = [tuple(float(rng.randint(0, 9)) for _ in NUMERIC_FEATURES) + (rng.choice("ab"), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in NUMERIC_FEATURES) + ", drug_name string, came_back int")
    model = MD.fit_gbt(df, 6, 3, 0.03)
    assert model.stages[-1].getNumTrees == 6 and rounds == [1]
    assert MD.scores(model, df).count() == 200


def test_equal_rows_are_stored_once(spark, monkeypatch):
    """Every round reads one row per set of bin numbers, with counts; before, every
    row of the table."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from dosewise.ml import gradient
    made, fit = [], gradient.distinct_rows
    monkeypatch.setattr(gradient, "distinct_rows", lambda *a: made.append(fit(*a)) or made[-1])
    df = spark.range(20_000).select(array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 3).cast("double"))).alias("features"),
                                    ((F.col("id") % 7 > 3) & (F.col("id") % 5 != 0)).cast("int").alias("came_back"))
    trees, _, _ = gradient.fit_trees(df, "features", "came_back", 2, 2, 0.1)
    assert made[0].count() == 21 and made[0].agg(F.sum("n0")).first()[0] == 20_000
    assert trees[0][0].count == 20_000
    assert trees[0][0].total == 2 * df.where("came_back = 1").count() - 20_000
