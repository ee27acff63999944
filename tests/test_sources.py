"""Sources and sinks: explicit-schema text read, write round trip (S1, S6),
bucketed layout removes the join/window shuffle (S8), JSON requests (S10)."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF0001, make_fills
from dosewise.sources import tables as T


def test_csv_round_trip_keeps_types(spark):
    path = tempfile.mkdtemp(dir="/tmp") + "/fills_csv"
    f = make_fills(spark, [(1, "7", "2024-01-01", 30), (2, "8", "2024-02-01", 90)])
    T.write_table(f.select("patient_id", "drug_id", "fill_dt", "supply_days"), path, fmt="csv")
    from pyspark.sql import types as Ty
    schema = Ty.StructType([Ty.StructField("patient_id", Ty.LongType()), Ty.StructField("drug_id", Ty.StringType()),
                            Ty.StructField("fill_dt", Ty.DateType()), Ty.StructField("supply_days", Ty.IntegerType())])
    back = T.read_table(spark, path, schema, fmt="csv")
    assert back.schema == schema
    assert sorted(back.collect()) == sorted(f.select("patient_id", "drug_id", "fill_dt", "supply_days").collect())


def test_bucketed_layout_skips_shuffle(spark):
    wh = tempfile.mkdtemp(dir="/tmp")
    name = "fills_bucketed_" + wh.rsplit("/", 1)[-1].replace("-", "_").replace("tmp", "")
    f = spark.read.parquet(f"{SF0001}/lineitem.parquet").select(
        F.col("l_orderkey").alias("patient_id"), "l_partkey", "l_shipdate")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.conf.set("spark.sql.legacy.createHiveTableByDefault", "false")
    f.write.option("path", wh + "/t").mode("overwrite").bucketBy(8, "patient_id").sortBy("patient_id") \
        .format("parquet").saveAsTable(name)
    t = spark.table(name)
    w = Window.partitionBy("patient_id").orderBy("l_shipdate")
    plan = t.withColumn("rn", F.row_number().over(w))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_parse_requests(spark):
    from pyspark.sql import types as Ty
    df = spark.createDataFrame([(1, '{"k": 69}'), (2, "not json")], "id int, body string")
    out = T.parse_requests(df, Ty.StructType([Ty.StructField("k", Ty.IntegerType())])).orderBy("id").collect()
    assert out[0]["k"] == 69 and out[1]["k"] is None


def test_table_counts(spark):
    a = spark.range(5)
    b = spark.range(3).withColumn("x", F.lit(1))
    r = {x["table_name"]: (x["n_rows"], x["n_cols"]) for x in T.table_counts({"a": a, "b": b}).collect()}
    assert r == {"a": (5, 1), "b": (3, 2)}
