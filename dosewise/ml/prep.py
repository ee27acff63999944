"""Model-table preparation.

* one-hot: ``StringIndexer(stringOrderType="alphabetAsc", handleInvalid="keep")``
  + ``OneHotEncoder(dropLast=True)``.  The extra "unknown" slot is the one
  dropped, so every category seen in training keeps its own column (in
  alphabetical order, like ``get_dummies``) and an unseen category encodes to
  all zeros - the reference's reindex(fill_value=0).
* standardise: population standard deviation, centred (the reference's
  scaler); Spark's ``StandardScaler`` would use the sample deviation.
* the fitted ``PipelineModel`` carries the feature order, so scoring can
  never mix up columns.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMERIC_FEATURES = ["patient_age", "is_branded", "supply_days", "fill_number", "prev_gap",
                    "was_late", "avg_gap", "pct_late"]


def one_hot_stages(col: str = "drug_name"):
    """Indexer + encoder stages for one categorical column."""
    idx = StringIndexer(inputCol=col, outputCol=f"{col}_idx", stringOrderType="alphabetAsc",
                        handleInvalid="keep")
    enc = OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[f"{col}_vec"], dropLast=True)
    return [idx, enc]


def feature_stages(numeric=NUMERIC_FEATURES, categorical: str | None = "drug_name",
                   out: str = "features"):
    """Stages that turn the model table into one vector column."""
    stages = one_hot_stages(categorical) if categorical else []
    inputs = list(numeric) + ([f"{categorical}_vec"] if categorical else [])
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return stages


def numeric_view(df: DataFrame, numeric=NUMERIC_FEATURES) -> DataFrame:
    """Booleans to 0/1 doubles, everything numeric as double."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])


def one_hot(train: DataFrame, df: DataFrame, col: str = "drug_name") -> DataFrame:
    """Encode ``df`` with categories fixed by ``train``; returns the
    vector as an array column ``{col}_onehot``."""
    from pyspark.ml.functions import vector_to_array
    model = Pipeline(stages=one_hot_stages(col)).fit(train)
    return model.transform(df).withColumn(f"{col}_onehot", vector_to_array(f"{col}_vec")).drop(
        f"{col}_idx", f"{col}_vec")


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std per column.  The statistics are one
    aggregate row, applied as scalar subqueries (no join, no collect).  A
    constant column becomes 0."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])).scalar()
    out = df
    for i, c in enumerate(cols):
        sd = stats[f"s_{i}"]
        z = (F.col(c).cast("double") - stats[f"m_{i}"]) / F.when(sd != 0, sd)
        out = out.withColumn(c + suffix, F.when(F.col(c).isNotNull(), F.coalesce(z, F.lit(0.0))))
    return out


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Plain numeric columns to one vector (D17 flatten for array columns: use
    ``array_to_vector``)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def flatten_window(df: DataFrame, col: str = "window", out: str = "features") -> DataFrame:
    """A 28-value window array to a feature vector."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(col))
