"""Readers of stored tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from filings_audit.schemas import RAW
from filings_audit.session import path_exists


def read_typed(spark: SparkSession, path: str, schema: T.StructType = RAW, fmt: str = "parquet") -> DataFrame:
    """A source in a fixed schema; fields the schema lacks are not read."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet reads as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def filings_source(spark: SparkSession, kind: str, **paths: str) -> DataFrame:
    """Choose the source of filings by name: ``intake`` (raw records) or ``live`` (the triage table)."""
    if kind == "intake":
        return read_typed(spark, paths["intake"], RAW, paths.get("fmt", "parquet"))
    if kind == "live":
        from filings_audit.sinks.gold import read_gold

        return read_gold(spark, paths["live"])
    raise ValueError(f"unknown source {kind!r}")
