import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dosewise.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8, app_name="dosewise-tests")
    yield s
    s.stop()


def D(s):
    return dt.date.fromisoformat(s)


def make_fills(spark, rows, start_key=1):
    """rows: (patient_id, drug_id, 'YYYY-MM-DD', supply_days[, disp_qty]) -> a
    fills table with the adapter's columns and a unique tie key."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("patient_id", T.LongType()), T.StructField("drug_id", T.StringType()),
        T.StructField("drug_name", T.StringType()), T.StructField("fill_dt", T.DateType()),
        T.StructField("supply_days", T.IntegerType()), T.StructField("disp_qty", T.DoubleType()),
        T.StructField("price", T.DoubleType()), T.StructField("copay", T.DoubleType()),
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_shipdate", T.TimestampType()), T.StructField("l_extendedprice", T.DoubleType()),
    ])
    data = []
    for i, r in enumerate(rows):
        p, d, day, sup = r[:4]
        qty = r[4] if len(r) > 4 else 1.0
        day = D(day)
        data.append((p, str(d), str(d), day, sup, float(qty), 10.0, 1.0, start_key + i, 1, 1, 1,
                     dt.datetime(day.year, day.month, day.day), 10.0))
    return spark.createDataFrame(data, schema)
