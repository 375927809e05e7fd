"""Fits of the forest under version numbers, for jobs that outlive a fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.operators.forest import Forest, ForestParams
from filings_audit.sources.tables import read_or_empty

LOG = T.StructType([T.StructField("version", T.LongType()), T.StructField("sample_size", T.LongType())])


def publish(trees: DataFrame, root: str, version: int, params: ForestParams = ForestParams()) -> None:
    """Store a fit. It is found once all of it is there: the log names it last."""
    trees.write.mode("overwrite").parquet(f"{root}/trees/version={version}")
    row = trees.sparkSession.createDataFrame([(version, params.sample_size)], LOG)
    row.coalesce(1).write.mode("append").parquet(f"{root}/log")


def newest(spark: SparkSession, root: str) -> int | None:
    return read_or_empty(spark, f"{root}/log", LOG).agg(F.max("version")).first()[0]


def load(spark: SparkSession, root: str, version: int) -> Forest:
    sizes = read_or_empty(spark, f"{root}/log", LOG).filter(F.col("version") == version)
    return Forest.collect(spark.read.parquet(f"{root}/trees/version={version}"), sizes.agg(F.max("sample_size")).first()[0])
