"""Plan shape (one shuffle for the course windows, pushdown, no Python on the
hot path), batch = stream, and the driver contract."""

import re

from pyspark.sql import functions as F

from conftest import SF0001
from dosewise.operators import courses as C
from dosewise.sources import adapter as A


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_course_pass_reads_the_facts_once(spark):
    """The windows run over the checkpointed ranges: no fact scan is left in
    the plan, all windows of a slice share one exchange, no Python."""
    h = C.course_history(A.fills(spark, SF0001))
    plan = _plan(h)
    assert "lineitem" not in plan and "FileScan" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    main = plan.split("BroadcastExchange")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(_range#\d+", main)) == 1


def test_training_table_has_no_python_and_prunes_columns(spark):
    from dosewise.plans import load_all
    q, _ = load_all()
    df = q["training_table"](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the line-item scan reads only the columns the query needs
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan.split("lineitem")[1] if "lineitem" in plan else plan)
    assert m is None or "l_tax" not in m.group(1)


def test_date_filter_pushed_to_scan(spark):
    li = A.table(spark, SF0001, "lineitem").filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    plan = _plan(li.select("l_orderkey"))
    assert "PushedFilters" in plan and "l_shipdate" in plan.split("PushedFilters")[1][:300]


def test_stream_history_equals_batch(spark):
    from dosewise.plans.q_courses import refill_features
    from dosewise.plans.q_streaming import stream_history
    s = stream_history(spark, SF0001).drop("late_arrival", "drug_id")
    cols = ["patient_id", "fill_dt", "l_orderkey", "l_linenumber", "fill_number", "prev_gap", "was_late",
            "avg_gap", "pct_late"]
    b = refill_features(spark, SF0001).select(*cols)
    assert s.select(*cols).exceptAll(b).count() == 0 and b.exceptAll(s.select(*cols)).count() == 0


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == C.FEATURES + ["runout_dt", "came_back"]
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 100


def test_oracle_matches_on_small_tables(spark):
    """A sample of cheap keys against DuckDB on sf0.001."""
    import duckdb
    import __spark_entry__ as E
    from tools.oracle_check import rows_of
    qs, orc = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in ["customer", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    for k in ["training_table", "late_summary", "lift_table", "demand_features", "psi", "roc_auc"]:
        a = qs[k](spark, SF0001).toArrow()
        b = con.sql(orc[k]).to_arrow_table()
        cols = sorted(a.column_names)
        assert cols == sorted(b.column_names), k
        assert rows_of(a.to_pylist(), cols) == rows_of(b.to_pylist(), cols), k


def test_pickup_day_bounds_reach_the_scan(spark):
    plan = _plan(A.fills(spark, SF0001, since=A.SPLIT_DATE))
    scans = [l for l in plan.splitlines() if "lineitem" in l and "PushedFilters" in l]
    assert scans and "GreaterThanOrEqual(l_shipdate" in scans[0]


def test_pair_counts_read_the_facts_once(spark):
    from dosewise.plans import load_all
    plan = _plan(load_all()[0]["lift_table"](spark, SF0001))
    assert "lineitem" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
