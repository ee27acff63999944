"""The training table as one Spark SQL statement.

Differences from the DataFrame version are those of the specification:
calendar age (completed years), means rounded half away from zero to 4 places,
integer prev_gap.  The course window runs over the pickups alone; dimensions
are joined to the finished rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dosewise.sources.adapter import TIE
from dosewise.sources.tables import run_sql


def statement(days_between: str, plus_days: str, month_day: str, fills: str, drugs: str, patients: str,
              last_day: str) -> str:
    """The statement; the arguments are what differs between SQL dialects."""
    course = f"PARTITION BY patient_id, drug_id ORDER BY fill_dt, {', '.join(TIE)}"
    supply_end = plus_days.format(d="fill_dt", n="supply_days")
    deadline = plus_days.format(d="fill_dt", n="supply_days + 14")
    # the pickup before the first one is taken to be one supply earlier, so a first gap is the supply
    first = plus_days.format(d="fill_dt", n="-supply_days")
    gap = days_between.format(later="fill_dt", earlier=f"LAG(fill_dt, 1, {first}) OVER course")
    return f"""
WITH pickup AS (
  SELECT patient_id, drug_id, fill_dt, supply_days, {', '.join(TIE)},
         {gap} AS prev_gap, ROW_NUMBER() OVER course AS fill_number,
         COALESCE(LEAD(fill_dt) OVER course <= {deadline}, FALSE) AS returned
  FROM {fills}
  WINDOW course AS ({course})
), so_far AS (
  SELECT *, CAST(prev_gap - supply_days > 14 AS INT) AS was_late,
         SUM(prev_gap) OVER past AS gap_days,
         SUM(CAST(prev_gap - supply_days > 14 AS INT)) OVER past AS late_count
  FROM pickup
  WINDOW past AS ({course} ROWS UNBOUNDED PRECEDING)
)
SELECT CAST(year(fill_dt) - year(birth_dt)
            - CAST({month_day.format(d="fill_dt")} < {month_day.format(d="birth_dt")} AS INT) AS INT) AS patient_age,
       drug_name, is_branded, supply_days, CAST(fill_number AS INT) AS fill_number,
       CAST(prev_gap AS INT) AS prev_gap, was_late,
       ROUND(CAST(gap_days AS DOUBLE) / fill_number, 4) AS avg_gap,
       ROUND(CAST(late_count AS DOUBLE) / fill_number, 4) AS pct_late,
       {supply_end} AS runout_dt,
       CAST(returned AS INT) AS came_back
FROM so_far
JOIN {drugs} USING (drug_id)
JOIN {patients} USING (patient_id)
WHERE {deadline} <= {last_day}
"""


TRAINING_SQL = statement("datediff({later}, {earlier})", "date_add({d}, {n})", "date_format({d}, 'MMdd')",
                         "dw_fills", "dw_drugs", "dw_patients",
                         "(SELECT MAX(CAST(l_shipdate AS DATE)) FROM dw_lineitem)")


def training_table_sql(spark: SparkSession, fills: DataFrame, patients: DataFrame,
                       drugs: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Register the inputs as views and run the
    statement (named windows, calendar age, ROUND, casts and COALESCE)."""
    return run_sql(spark, TRAINING_SQL, {
        "dw_fills": fills, "dw_patients": patients.select("patient_id", "birth_dt"),
        "dw_drugs": drugs.select("drug_id", "drug_name", "is_branded"), "dw_lineitem": lineitem})
