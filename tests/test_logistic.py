"""Logistic fits over packed rows: Spark's own weights, whatever the blocks and the
categories; rows that the packed form does not hold are left to Spark's fit."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array

from dosewise.ml import models as MD
from dosewise.ml.prep import NUMERIC_FEATURES, feature_stages

SCHEMA = ", ".join(f"{c} double" for c in NUMERIC_FEATURES) + ", drug_name string, came_back int"


def _rows(n, drugs=("w", "x", "y", None)):
    rng = random.Random(5)
    out = []
    for i in range(n):
        late, drug, gap = float(rng.random() < 0.2), rng.choice(drugs), float(rng.randint(1, 400))
        y = int(gap / 200 + (1.0 if drug == "x" else 0) - late + rng.gauss(0, 1) > 1.2)
        # one column has the same value everywhere
        out.append((float(rng.randint(5, 90)), float(drug == "w"), 30.0, float(rng.randint(1, 9)), gap, late,
                    round(gap * rng.random(), 6), round(late * rng.random(), 6), drug, y))
    return out


def _spark_fit(df, scaled):
    n = df.count()
    lr = LogisticRegression(labelCol="came_back", maxIter=1000, regParam=1.0 / n, standardization=False,
                            featuresCol="z" if scaled else "features")
    scale = [StandardScaler(inputCol="features", outputCol="z", withMean=True, withStd=True)] if scaled else []
    return Pipeline(stages=feature_stages() + scale + [lr]).fit(df)


def _scores(model, df):
    return [r.p for r in model.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()]


@pytest.mark.parametrize("batch", [10_000, 7])
def test_shared_rows_give_sparks_weights(spark, batch):
    df = spark.createDataFrame(_rows(1500), SCHEMA).repartition(3).cache()
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        shared = MD.logistic_rows(df)
        plain, scaled = MD.fit_logistic(df, shared=shared), MD.fit_scaled_logistic(df, shared=shared)
        shared.rows.release()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    theirs = _spark_fit(df, False)
    assert plain.stages[-1].coefficients.toArray() == pytest.approx(theirs.stages[-1].coefficients.toArray(), rel=1e-6, abs=1e-9)
    assert plain.stages[-1].intercept == pytest.approx(theirs.stages[-1].intercept, rel=1e-6)
    assert _scores(plain, df) == pytest.approx(_scores(theirs, df), abs=1e-8)
    # the scaler of the whole pipeline: population deviation, centred
    z = np.array([r.z for r in scaled.transform(df).select(vector_to_array("features").alias("z")).collect()])
    assert z.mean(axis=0) == pytest.approx(0, abs=1e-9)
    assert [round(s, 9) for s in z.std(axis=0)] == [1, 1, 0, 1, 1, 1, 1, 1, 1, 1, 1]
    assert _scores(scaled, df) == pytest.approx(_scores(_spark_fit(df, True), df), abs=1e-3)
    assert plain.stages[-1].getMaxIter() == 1000 and plain.stages[-1].getRegParam() == 1 / 1500


def test_odd_rows_are_fitted_as_before(spark):
    rows = _rows(60)
    one_label = spark.createDataFrame([(*r[:-1], 1) for r in rows], SCHEMA)
    assert MD.fit_logistic(one_label).stages[-1].intercept == _spark_fit(one_label, False).stages[-1].intercept == float("inf")
    missing = spark.createDataFrame([(None, *rows[0][1:]), *rows[1:]], SCHEMA)
    for f in (MD.fit_logistic, MD.fit_scaled_logistic):
        with pytest.raises(Exception, match="NaN"):
            f(missing)


def test_packed_numbers_are_exact():
    from dosewise.ml.logistic import small
    for v, t in (([1.0, -100.0], np.int8), ([300.0, 0.0], np.int16), ([7e4, 1.0], np.int32), ([0.5, 1.0], float), ([np.nan, 1.0], float),
                 ([3e9, 1.0], float)):
        x = np.array(v)
        assert small(x).dtype == t and np.array_equal(small(x), x, equal_nan=True)
