"""Scans, sinks and table layout.

Every read takes an explicit schema for text formats: identifiers such as
NDC codes or ZIP codes keep their leading zeros, dates arrive as dates.
Parquet carries its own schema and gets filter/column pushdown.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Domain schemas (explicit, never inferred).
FILLS_SCHEMA = T.StructType([
    T.StructField("fill_id", T.LongType()), T.StructField("presc_id", T.LongType()),
    T.StructField("patient_id", T.LongType()), T.StructField("drug_id", T.IntegerType()),
    T.StructField("refill_num", T.IntegerType()), T.StructField("fill_dt", T.DateType()),
    T.StructField("supply_days", T.IntegerType()), T.StructField("disp_qty", T.DoubleType()),
    T.StructField("daw_id", T.IntegerType()), T.StructField("price", T.DoubleType()),
    T.StructField("copay", T.DoubleType()), T.StructField("insurance_id", T.IntegerType()),
    T.StructField("status", T.StringType()),
])

REFILL_REQUEST_SCHEMA = T.StructType([
    T.StructField("patient_age", T.IntegerType()), T.StructField("drug_name", T.StringType()),
    T.StructField("is_branded", T.BooleanType()), T.StructField("supply_days", T.IntegerType()),
    T.StructField("fill_number", T.IntegerType()), T.StructField("prev_gap", T.DoubleType()),
    T.StructField("was_late", T.IntegerType()), T.StructField("avg_gap", T.DoubleType()),
    T.StructField("pct_late", T.DoubleType()),
])

DEMAND_REQUEST_SCHEMA = T.StructType([
    T.StructField("drug_id", T.StringType()), T.StructField("as_of", T.DateType()),
    T.StructField("daily_units", T.ArrayType(T.DoubleType())),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read a delimited file with a header (explicit schema, dates parsed
    by the schema) or a Parquet table."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        if schema is None:
            raise ValueError("text tables need an explicit schema")
        return (spark.read.schema(schema).option("header", True)
                .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").csv(path))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path)


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """S3: register DataFrames as temp views and run SQL text over them."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def load_tables(spark: SparkSession, mapping: dict[str, DataFrame], mode: str = "overwrite",
                database: str | None = None) -> dict[str, int]:
    """Write several DataFrames as catalog tables (replace if present) and
    return their row counts, read back from the written tables."""
    counts = {}
    for name, df in mapping.items():
        full = f"{database}.{name}" if database else name
        df.write.mode(mode).format("parquet").saveAsTable(full)
        counts[name] = spark.table(full).count()
    return counts


def table_counts(dfs: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row and column count (one aggregate job
    per table, combined with a union)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows",
                       F.lit(len(df.columns)).alias("n_cols"))
             for name, df in dfs.items()]
    return reduce(DataFrame.unionByName, parts)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a result table (no row index exists in Spark)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_ordered(df: DataFrame, keys: list, path: str, fmt: str = "parquet") -> None:
    """Write a work queue in a global order.  ``orderBy`` range-partitions
    on the keys (sampled bounds), so part files are ordered and each is sorted."""
    write_table(df.orderBy(*keys), path, fmt=fmt)


def layout(df: DataFrame, name: str, bucket_by: list[str] | None = None,
           n_buckets: int = 64, sort_by: list[str] | None = None,
           partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Lay a table out for its join/filter columns (the Spark form of the
    reference's indexes): bucket + sort on the join key so later joins and
    windows on it skip the shuffle; partition on a date column so date filters
    prune whole folders."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(n_buckets, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(name)


def write_pruned(df: DataFrame, path: str, date_col: str, key: str, mode: str = "overwrite") -> None:
    """Files laid out for a filter on a day and on a key.  One folder per
    month; inside a task rows are sorted by month and key, so the row groups'
    minima and maxima skip a range of keys, and a Bloom filter per row group skips
    a single one.  Months are spread over tasks by the key as well, so a month
    with most rows is no hot task."""
    parts = df.withColumn("month", F.date_format(date_col, "yyyy-MM"))
    slices = F.pmod(F.xxhash64(key), F.lit(8))
    (parts.repartition("month", slices).sortWithinPartitions("month", key)
     .write.mode(mode).partitionBy("month").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def read_pruned(spark: SparkSession, path: str, schema: T.StructType, date_col: str, since: str, until: str) -> DataFrame:
    """Rows of ``write_pruned`` with ``since`` <= day < ``until`` (ISO days): whole
    folders outside those months are never listed for the scan.  Rows without a
    day match no range."""
    full = T.StructType([*schema.fields, T.StructField("month", T.StringType())])
    day = F.col(date_col)
    return (spark.read.schema(full).parquet(path).filter(F.col("month").between(since[:7], until[:7]))
            .filter((day >= F.lit(since).cast("date")) & (day < F.lit(until).cast("date"))).drop("month"))


def parse_requests(df: DataFrame, schema: T.StructType, col: str = "body") -> DataFrame:
    """Parse JSON request text into typed columns (bad records -> nulls)."""
    return df.select("*", F.from_json(F.col(col), schema).alias("_req")).select(
        *[c for c in df.columns], "_req.*")
