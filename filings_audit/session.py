"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from filings_audit.sources.storage import settings_from

# All of these can be set on a running session, so a session made elsewhere is tuned as well.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small stages keep their parallelism: hashing, matching and scoring cost far more per byte than a scan.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # Split hot join keys even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method of more than 8000 bytes. A stage whose code is longer is generated operator by
    # operator, in small methods, and not as one that is interpreted for every row.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan in this package relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "filings-audit", master: str | None = None, extra: dict | None = None) -> SparkSession:
    """Get a configured session that can read the storage account the environment names.

    The master is left to spark-submit unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings_from(), **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or where that is unset the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/filings_audit/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object, for metadata calls."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def materialize(df, label: str):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table, so a lost executor re-reads files instead of recomputing the plan.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
