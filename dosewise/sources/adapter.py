"""Map the driver's star-schema tables onto the pharmacy domain.

One module owns the mapping so every operator reads domain names only:

fills      one row per pickup (a line item): patient = ordering customer,
           drug = part type (or brand for baskets), pickup day = ship day.
patients   one row per customer, with a derived birth date and payer.
drugs      one row per drug, derived from the distinct part types.

The same mapping is written as SQL in ``dosewise.plans.registry`` so the DuckDB
oracle sees exactly the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (they must be identical in the oracle SQL).
LONG_SUPPLY_TYPES = ["ECONOMY", "LARGE", "MEDIUM"]   # 90-day supply; all others 30
BRANDED_TYPES = ["LARGE", "PROMO", "STANDARD"]       # is_branded
CONTROLLED_TYPES = ["PROMO"]                         # drug_class 5; all others 0
BIRTH_BASE = "1930-01-01"                            # birth = base + custkey*37 % 22000 days
SPLIT_DATE = "2001-01-01"                            # train before, test on/after

# Order of pickups inside a course: the day, then a key unique per line item.
TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
ORDER = ["fill_dt"] + TIE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supply_days(drug: Column) -> Column:
    return F.when(drug.isin(LONG_SUPPLY_TYPES), F.lit(90)).otherwise(F.lit(30))


def fills(spark: SparkSession, sf_dir: str, item: str = "p_type", since: str | None = None,
          until: str | None = None) -> DataFrame:
    """Pickup fact table.

    ``item`` picks the part attribute that plays the drug: ``p_type`` (6
    values, long courses) or ``p_brand`` (25 values, for baskets).
    Only the columns used downstream are read; Catalyst prunes the rest at
    the Parquet scan.  lineitem -> orders is a many-to-one join on the order
    key; part is joined on the part key.  Both dimension joins are left to
    the planner: it broadcasts a side only when its measured size is under
    the broadcast threshold and shuffles otherwise.

    ``since`` / ``until`` (ISO days, until exclusive) bound the pickup day on
    the raw ship timestamp before any join, so they reach the Parquet scan as
    pushed filters and skip row groups.
    """
    li = table(spark, sf_dir, "lineitem")
    ship_t = li.schema["l_shipdate"].dataType.simpleString()
    if since:
        li = li.filter(F.col("l_shipdate") >= F.lit(since).cast(ship_t))
    if until:
        li = li.filter(F.col("l_shipdate") < F.lit(until).cast(ship_t))
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient_id"))
    pt = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col(item).alias("drug_id"), "p_type")
    df = li.join(od, "l_orderkey").join(pt, "l_partkey")
    return df.select(
        "patient_id",
        "drug_id",
        F.col("drug_id").alias("drug_name"),
        F.col("l_shipdate").cast("date").alias("fill_dt"),
        supply_days(F.col("p_type")).alias("supply_days"),
        F.col("l_quantity").alias("disp_qty"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("copay"),
        *TIE,
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("patient_id"),
        F.date_add(F.lit(BIRTH_BASE).cast("date"),
                   ((F.col("c_custkey") * 37) % 22000).cast("int")).alias("birth_dt"),
        F.col("c_mktsegment").alias("payer"),
        F.col("c_nationkey").alias("nation_id"),
    )


def drugs(spark: SparkSession, sf_dir: str, item: str = "p_type") -> DataFrame:
    """Drug dimension: one row per distinct item value (partial aggregation,
    so only distinct values cross the shuffle)."""
    p = table(spark, sf_dir, "part").select(F.col(item).alias("drug_id"), "p_type")
    d = p.groupBy("drug_id").agg(F.min("p_type").alias("p_type"))
    return d.select(
        "drug_id",
        F.col("drug_id").alias("drug_name"),
        F.col("drug_id").isin(BRANDED_TYPES).alias("is_branded"),
        F.when(F.col("drug_id").isin(CONTROLLED_TYPES), F.lit(5)).otherwise(F.lit(0)).alias("drug_class"),
        supply_days(F.col("p_type")).alias("default_days"),
    )


def payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payer dimension (insurer) from the customer market segment."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("payer")).distinct()
