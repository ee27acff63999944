"""Bulk scoring of refill and demand requests (V1-V5), the batch form of the
reference's HTTP endpoints: a table of requests in, a table of decisions out.
The fitted pipeline is loaded once per job and applied with ``transform``
(JVM-side), never row by row in Python.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.functions.scalars import band

# Fixed decision bands (probability of refilling on time -> risk, action).
RISK_CUTS = [0.40, 0.70]
RISK_LABELS = ["high", "medium", "low"]
ACTIONS = {"high": "pharmacist call", "medium": "send reminder", "low": "no action"}


def refill_rules() -> dict[str, Column]:
    """Fixed request rules (name -> condition that must hold)."""
    return {
        "patient_age must be within 0..120": F.col("patient_age").between(0, 120),
        "was_late must be 0 or 1": F.col("was_late").between(0, 1),
        "pct_late must be within 0..1": F.col("pct_late").between(0, 1),
    }


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """V3: add ``reason`` (every failed rule, '; '-joined; '' when none) and
    ``accepted``.  A rule that evaluates to NULL counts as failed."""
    msgs = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    out = df.withColumn("reason", F.concat_ws("; ", *msgs))
    return out.withColumn("accepted", F.col("reason") == F.lit(""))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """V3: (accepted rows, rejected rows with reasons)."""
    v = validate(df, rules)
    return v.filter("accepted").drop("reason", "accepted"), v.filter(~F.col("accepted"))


def risk_bands(df: DataFrame, prob: str = "probability") -> DataFrame:
    """V2: probability -> risk (>= 0.70 low, >= 0.40 medium, else high) and
    action; probability rounded half to even to 3 places."""
    risk = band(prob, RISK_CUTS, RISK_LABELS)
    action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[risk]
    return df.select("*", F.bround(F.col(prob), 3).alias("refill_probability"),
                     risk.alias("risk"), action.alias("action"))


def score_refills(df: DataFrame, model: PipelineModel) -> DataFrame:
    """V1: probability of refilling on time for every request row."""
    out = model.transform(df)
    return out.withColumn("probability", vector_to_array("probability")[1]).drop(
        "rawPrediction", "prediction", "features")


def suggested_order(df: DataFrame, forecast: str = "forecast", buffer: float = 0.1) -> DataFrame:
    """Forecast and order quantity (forecast x (1 + buffer)), both
    rounded half to even as integers."""
    return df.select("*", F.bround(F.col(forecast), 0).cast("long").alias("forecast_next_7_days"),
                     F.bround(F.col(forecast) * F.lit(1.0 + buffer), 0).cast("long").alias("suggested_order"))


def score_demand(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """V4: features from raw histories (D16), model forecast, order."""
    from dosewise.operators.demand import request_features
    feats = request_features(requests)
    out = model.transform(feats).withColumnRenamed("prediction", "forecast")
    return suggested_order(out, "forecast")
