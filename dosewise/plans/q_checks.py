"""Queries that check what has no SQL form: sources and layouts read back,
requests that break every rule, and the conditions that a fitted model must
meet.  Each model check is one row of facts that must hold, over whole tables;
its oracle states them.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dosewise.ml import models as MD
from dosewise.ml import prep as P
from dosewise.ml.scoring import refill_rules, validate
from dosewise.plans import q_models as QM
from dosewise.plans.q_courses import training_table
from dosewise.plans.q_quality import TT_SQL
from dosewise.plans.registry import fills_sql, register
from dosewise.session import stored
from dosewise.sources import adapter as A
from dosewise.sources import tables as S


# --- sources and layouts ----------------------------------------------------------------

@register("load_tables", """SELECT 'dw_customer' AS table_name, COUNT(*) AS n_rows FROM customer
UNION ALL SELECT 'dw_orders', COUNT(*) FROM orders UNION ALL SELECT 'dw_part', COUNT(*) FROM part""")
def load_tables(spark, sf):
    """Three files bulk-loaded as catalog tables (replaced if present);
    row counts read back from the tables."""
    tag = uuid.uuid4().hex[:8]
    names = {f"dw_{t}_{tag}": A.table(spark, sf, t) for t in ("customer", "orders", "part")}
    counts = S.load_tables(spark, names)
    out = spark.createDataFrame([(n.rsplit("_", 1)[0], c) for n, c in counts.items()], "table_name string, n_rows long")
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    return out


@register("bucketed_join", f"""SELECT o.o_orderpriority AS priority, COUNT(*) AS n, CAST(SUM(l.l_linenumber) AS BIGINT) AS lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def bucketed_join(spark, sf):
    """Both sides laid out by the join key, joined bucket by bucket."""
    tag = uuid.uuid4().hex[:8]
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    od = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    S.layout(li, f"dw_li_{tag}", ["l_orderkey"], 8, ["l_orderkey"])
    S.layout(od, f"dw_od_{tag}", ["l_orderkey"], 8, ["l_orderkey"])
    joined = spark.table(f"dw_li_{tag}").join(spark.table(f"dw_od_{tag}"), "l_orderkey")
    out = stored(joined.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines")), "bucketed")
    for t in ("li", "od"):
        spark.sql(f"DROP TABLE dw_{t}_{tag}")
    return out


@register("csv_round_trip", f"""WITH fills AS ({fills_sql()})
SELECT patient_id, drug_id, fill_dt, supply_days, disp_qty FROM fills""")
def csv_round_trip(spark, sf):
    """Pickups written as delimited text with a header and read back
    under an explicit schema, dates parsed by it."""
    from dosewise.session import ensure_checkpoint_dir
    cols = A.fills(spark, sf).select("patient_id", "drug_id", "fill_dt", "supply_days", "disp_qty")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fills-{uuid.uuid4().hex}.csv"
    S.write_table(cols, path, fmt="csv")
    return S.read_table(spark, path, cols.schema, "csv")


# --- validation --------------------------------------------------------------------------

_BROKEN = ["patient_age + (fill_number - 3) * 15", "was_late + CASE WHEN supply_days = 90 THEN 1 ELSE 0 END",
           "pct_late * 1.5 - 0.1"]
_RULES = [("patient_age must be within 0..120", "patient_age BETWEEN 0 AND 120"),
          ("was_late must be 0 or 1", "was_late BETWEEN 0 AND 1"),
          ("pct_late must be within 0..1", "pct_late BETWEEN 0 AND 1")]


@register("refill_request_validation", f"""{TT_SQL},
req AS (SELECT {_BROKEN[0]} AS patient_age, {_BROKEN[1]} AS was_late, round({_BROKEN[2]}, 6) AS pct_late FROM tt),
checked AS (SELECT *, concat_ws('; ', {', '.join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _RULES)}) AS reason FROM req)
SELECT reason, reason = '' AS accepted, COUNT(*) AS n, MIN(patient_age) AS youngest, MAX(patient_age) AS oldest FROM checked GROUP BY 1, 2""")
def refill_request_validation(spark, sf):
    """V3: requests derived from the training rows so that every rule is broken
    by some; rows per set of reasons."""
    t = training_table(spark, sf)
    req = t.select(F.expr(_BROKEN[0]).alias("patient_age"), F.expr(_BROKEN[1]).alias("was_late"),
                   F.round(F.expr(_BROKEN[2].replace("1.5", "1.5D").replace("0.1", "0.1D")), 6).alias("pct_late"))
    return validate(req, refill_rules()).groupBy("reason", "accepted").agg(
        F.count(F.lit(1)).alias("n"), F.min("patient_age").alias("youngest"), F.max("patient_age").alias("oldest"))


# --- what must hold for fitted models -------------------------------------------------------

def _facts(spark, **facts):
    return spark.createDataFrame([tuple(bool(v) for v in facts.values())],
                                 ", ".join(f"{k} boolean" for k in facts))


@register("logistic_optimum", "SELECT true AS unscaled_is_optimal, true AS scaled_is_optimal, true AS scores_in_range")
def logistic_optimum(spark, sf):
    """M1/M2: at the fitted weights the gradient of the penalised likelihood is
    close to zero, measured against the gradient at zero weights."""
    train, test = QM._split(spark, sf)
    n = train.count()

    def flat(model, features):
        """|gradient| at the weights over |gradient| at no weights but the share."""
        lr = model.stages[-1]
        w = lr.coefficients.toArray()
        x = model.transform(train).select(vector_to_array(features).alias("x"), F.col("came_back").alias("y"),
                                          vector_to_array("probability")[1].alias("p"))
        share = x.agg(F.avg("y")).first()[0]
        sums = x.agg(*[F.sum((F.col("p") - F.col("y")) * F.col("x")[j]).alias(f"g{j}") for j in range(len(w))],
                     *[F.sum((F.lit(share) - F.col("y")) * F.col("x")[j]).alias(f"z{j}") for j in range(len(w))]).first()
        g = np.array([sums[f"g{j}"] for j in range(len(w))]) / n + w / n
        z = np.array([sums[f"z{j}"] for j in range(len(w))]) / n
        return np.abs(g).max() / np.abs(z).max()

    shared = MD.logistic_rows(train)
    plain, scaled = MD.fit_logistic(train, shared=shared), MD.fit_scaled_logistic(train, shared=shared)
    shared.rows.release()
    low, high = MD.scores(plain, test).agg(F.min("score"), F.max("score")).first()
    return _facts(spark, unscaled_is_optimal=flat(plain, "features") < 0.02, scaled_is_optimal=flat(scaled, "features") < 0.02,
                  scores_in_range=0 <= low < high <= 1)


@register("attribution_check", "SELECT true AS adds_up_to_model, true AS every_test_row, true AS importance_adds_to_one")
def attribution_check(spark, sf):
    """Attributions and base value add up to the model's own
    log-odds on every test row; importances add up to 1."""
    train, test = QM._split(spark, sf)
    model = MD.fit_gbt(train, 200, 3, 0.03)
    a, _ = QM._attributions(spark, sf, model)
    own = F.log(F.col("probability") / (1 - F.col("probability")))
    total = F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x) + F.col("base_value")
    worst, n = a.agg(F.max(F.abs(total - own)), F.count(F.lit(1))).first()
    imp = MD.feature_importance(model, spark).agg(F.sum("importance")).first()[0]
    return _facts(spark, adds_up_to_model=worst < 1e-6, every_test_row=n == test.count(), importance_adds_to_one=abs(imp - 1) < 1e-9)


@register("segment_check", "SELECT true AS cost_is_sum_of_squares, true AS nearest_centre, true AS cost_falls_with_k, "
          "true AS shares_are_variances")
def segment_check(spark, sf):
    """The k-means cost is the sum of squared distances to the
    nearest centre and falls with k; the projection's shares are its
    coordinates' variances over the total."""
    p = QM._profiles(spark, sf)
    rows, models = MD.kmeans_sweep(p, ks=[2, 4, 7], restarts=3)
    m = models[4]
    centres = m.clusterCenters()
    x = m.transform(p).select("segment", vector_to_array("features").alias("x"))
    d = [sum(((F.col("x")[j] - float(c[j])) ** 2 for j in range(len(c))), F.lit(0.0)) for c in centres]
    x = x.select("segment", F.array(*d).alias("d"))
    cost, off = x.agg(F.sum(F.array_min("d")), F.max(F.element_at("d", F.col("segment") + 1) - F.array_min("d"))).first()
    four = next(r for r in rows if r["k"] == 4)
    coords, ev = MD.project_2d(p)
    width = len(centres[0])
    v = coords.select("pc1", "pc2", vector_to_array("features").alias("x")).agg(
        F.var_samp("pc1").alias("a"), F.var_samp("pc2").alias("b"),
        sum((F.var_samp(F.col("x")[j]) for j in range(width)), F.lit(0.0)).alias("t")).first()
    return _facts(spark, cost_is_sum_of_squares=abs(cost - four["inertia"]) < 1e-6 * cost, nearest_centre=off < 1e-9,
                  cost_falls_with_k=rows[0]["inertia"] > rows[1]["inertia"] > rows[2]["inertia"],
                  shares_are_variances=abs(v.a / v.t - ev[0]) < 1e-9 and abs(v.b / v.t - ev[1]) < 1e-9)


@register("anomaly_check", "SELECT true AS scores_in_range, true AS budget_is_met, true AS error_is_left_over_variance")
def anomaly_check(spark, sf):
    """Forest scores lie between -1 and 0 and 5 % are flagged; the
    mean rebuild error is the variance that two components leave."""
    z = stored(QM._controlled(spark, sf), "controlled")
    s = QM.isolation_of(z).agg(F.min("anomaly_score").alias("lo"), F.max("anomaly_score").alias("hi"),
                                           F.avg(F.col("flagged").cast("int")).alias("share")).first()
    v = stored(MD.standardized_vector(z, QM.CONTROLLED_COLS), "vectors")
    _, ev = MD.project_2d(v)
    err = MD.rebuild_error(v).agg(F.avg("error")).first()[0]
    return _facts(spark, scores_in_range=-1 < s.lo < s.hi < 0, budget_is_met=abs(s.share - 0.05) < 0.01,
                  error_is_left_over_variance=abs(err - (1 - sum(ev))) < 1e-6)


@register("stream_score_check", "SELECT true AS same_rows, true AS same_scores")
def stream_score_check(spark, sf):
    """ST4: scores of the stream are those of the batch."""
    from dosewise.ml.scoring import risk_bands
    from dosewise.plans.q_streaming import score_stream
    t = QM._training(spark, sf)      # written once for both
    train, test = QM.R.temporal_split(t, "runout_dt", QM.SPLIT)
    batch = risk_bands(MD.fit_logistic(train).transform(test).withColumn("probability", vector_to_array("probability")[1]))
    keys = ["drug_name", "fill_number", "risk", "action", "came_back"]
    a = score_stream(spark, sf, t).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("refill_probability").alias("p"))
    b = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.sum("refill_probability").alias("q"))
    off = a.join(b, keys, "full").agg(
        F.max(F.coalesce((F.col("n") != F.col("m")).cast("int"), F.lit(1))).alias("rows"),
        F.max(F.coalesce(F.abs(F.col("p") - F.col("q")), F.lit(1.0))).alias("p")).first()
    return _facts(spark, same_rows=off.rows == 0, same_scores=off.p < 1e-6)


@register("forecast_check", "SELECT true AS stream_is_batch, true AS orders_follow_forecasts")
def forecast_check(spark, sf):
    """ST5/V4/V5: forecasts of the stream are those of the batch; an order is
    the forecast plus a tenth, rounded half to even."""
    from dosewise.ml.scoring import score_demand
    from dosewise.plans.q_streaming import forecast_model, forecast_stream
    model, req = forecast_model(spark, sf)
    a = stored(forecast_stream(spark, req, model), "stream")
    b = score_demand(req, model).withColumnRenamed("forecast", "f")
    off = a.join(b.select("drug_id", "as_of", "f"), ["drug_id", "as_of"], "full").agg(
        F.max(F.coalesce(F.abs(F.col("forecast") - F.col("f")), F.lit(1e9))).alias("d")).first().d
    wrong = a.filter((F.col("suggested_order") != F.bround(F.col("forecast") * 1.1, 0).cast("long"))).count()
    return _facts(spark, stream_is_batch=off < 1e-6, orders_follow_forecasts=wrong == 0)


@register("network_check", "SELECT true AS rebuilds_better_than_two_components, true AS recurrent_close_to_naive_or_better")
def network_check(spark, sf):
    """The bottleneck's mean rebuild error is below that of two principal
    components on the same rows; the recurrent network's mean absolute error is
    at most a tenth above the last-week forecast's."""
    e = QM.network_error(spark, sf).agg(F.avg("error").alias("net"), F.avg("linear_error").alias("linear")).first()
    d = QM.recurrent_demand(spark, sf).agg(F.avg(F.abs(F.col("forecast") - F.col("units"))).alias("net"),
                                           F.avg(F.abs(F.col("naive") - F.col("units"))).alias("naive")).first()
    return _facts(spark, rebuilds_better_than_two_components=e.net < e.linear,
                  recurrent_close_to_naive_or_better=d.net <= 1.1 * d.naive)
