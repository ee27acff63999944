"""Session helpers.

The library never assumes it owns the session: every operator takes a
DataFrame (or a SparkSession) and works with whatever configuration the
cluster provides.  ``get_spark`` is only a convenience for tests, the bench
and notebooks.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for the plans this library builds.  AQE re-plans joins
# from runtime sizes (broadcast only when the shuffled side is measured small),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dosewise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's recommended settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", _driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _driver_memory() -> str:
    """Local mode runs everything in the driver JVM: give it ~60 % of the
    machine's memory, at most 16 GiB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; a
    cluster session without it is refused, since a machine-local folder is
    not visible to the other machines.  Only a local session gets a scratch
    folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="dosewise-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame reading from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df, name: str = "table"):
    """Write ``df`` as Parquet under the shared checkpoint folder and return a
    DataFrame over those files.  Unlike ``checkpoint()`` later reads prune
    columns and the planner sees the true size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.
    Its cleaner acts when the driver's heap is collected, which a large heap puts off
    until long after a table is ``stored``."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def few_tasks(df, rows_a_task: int = 1 << 16):
    """``df`` written and read back with a task for so many rows: a fit of many
    rounds starts a round's tasks for every partition, however small."""
    from pyspark.sql import functions as F
    t = stored(df, "few")
    n = t.agg(F.count(F.lit(1))).first()[0]
    return t.coalesce(max(1, -(-n // rows_a_task)))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that Python
    workers can import it wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_dosewise_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="dosewise-ship-")
    path = os.path.join(folder, "dosewise-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(os.path.join(root, "dosewise")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._dosewise_shipped = True
