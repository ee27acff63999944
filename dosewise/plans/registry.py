"""Registry of named queries over the driver tables.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  A query with an ``oracle``
also carries the equivalent DuckDB SQL over the raw driver tables, which the
correctness gate runs side by side.  Computed columns carry the same alias on
both sides; doubles whose last bits depend on summation order are rounded on
both sides.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# Fixed mapping of the driver tables onto pickups, as SQL (mirrors
# dosewise.sources.adapter; the values must stay identical).
def fills_sql(item: str = "p_type") -> str:
    return f"""
    SELECT o.o_custkey AS patient_id,
           p.{item} AS drug_id,
           p.{item} AS drug_name,
           CAST(l.l_shipdate AS DATE) AS fill_dt,
           CASE WHEN p.p_type IN ('ECONOMY', 'LARGE', 'MEDIUM') THEN 90 ELSE 30 END AS supply_days,
           l.l_quantity AS disp_qty,
           l.l_extendedprice AS price,
           l.l_extendedprice * l.l_discount AS copay,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    """


PATIENTS_SQL = """
    SELECT c_custkey AS patient_id,
           CAST(DATE '1930-01-01' + CAST((c_custkey * 37) % 22000 AS INTEGER) AS DATE) AS birth_dt,
           c_mktsegment AS payer,
           c_nationkey AS nation_id
    FROM customer
"""

DRUGS_SQL = """
    SELECT drug_id, drug_id AS drug_name,
           drug_id IN ('LARGE', 'PROMO', 'STANDARD') AS is_branded,
           CASE WHEN drug_id IN ('PROMO') THEN 5 ELSE 0 END AS drug_class
    FROM (SELECT DISTINCT p_type AS drug_id FROM part)
"""

ORDER_SQL = "fill_dt, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
COURSE_W = f"PARTITION BY patient_id, drug_id ORDER BY {ORDER_SQL}"

# Label + features over the course window (the oracle twin of course_history).
HISTORY_SQL = f"""
    h0 AS (
      SELECT f.*,
             LEAD(fill_dt) OVER w AS next_fill_dt,
             CAST(COALESCE(fill_dt - LAG(fill_dt) OVER w, supply_days) AS DOUBLE) AS prev_gap,
             CAST(ROW_NUMBER() OVER w AS INTEGER) AS fill_number,
             CAST(fill_dt + supply_days AS DATE) AS runout_dt
      FROM fills f
      WINDOW w AS ({COURSE_W})
    ),
    h1 AS (
      SELECT *,
             CAST(next_fill_dt - runout_dt AS INTEGER) AS days_late,
             CASE WHEN next_fill_dt - runout_dt <= 14 THEN 1 ELSE 0 END AS came_back,
             CASE WHEN prev_gap > supply_days + 14 THEN 1 ELSE 0 END AS was_late
      FROM h0
    ),
    hist AS (
      SELECT *,
             AVG(prev_gap) OVER h AS avg_gap,
             AVG(was_late) OVER h AS pct_late
      FROM h1
      WINDOW h AS ({COURSE_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )
"""

CENSOR_SQL = "runout_dt <= (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem) - 14"
