"""M9 over a stored table: mask again only what was masked under another version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.operators import masking
from filings_audit.operators.masking import MaskingConfig
from filings_audit.sources.tables import read_or_empty

QUARTERS = ("edgar_year", "edgar_quarter")
TOGETHER = 8  # partitions that one job rewrites


def outdated(raw: DataFrame, masked_path: str, version: str, keys: tuple[str, ...] = QUARTERS) -> DataFrame:
    """Partitions of ``raw`` that have no masked rows, or some of another version. Reads the version column alone."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("masking_version", *keys)])
    stored = read_or_empty(raw.sparkSession, masked_path, schema)
    current = stored.groupBy(*keys).agg(F.bool_and(F.col("masking_version").eqNullSafe(version)).alias("current"))
    return raw.select(*keys).distinct().join(current.filter("current"), [*keys], "left_anti")


def rotate(
    raw: DataFrame, masked_path: str, config: MaskingConfig, salt: str, version: str,
    keys: tuple[str, ...] = QUARTERS, at_most: int | None = None, together: int = TOGETHER,
) -> list[tuple[str, ...]]:
    """Bring the masked copy of ``raw`` to a salt and version; returns the partitions it rewrote.

    ``raw`` is a table partitioned by ``keys``, texts that are never null. A few partitions at a time are masked from the raw rows and
    replaced as a whole, so a run that ends half way, or after ``at_most`` partitions, is taken up where it stopped by
    calling it again. Partitions that ``raw`` no longer has stay as they are.
    """
    found = sorted(tuple(row) for row in outdated(raw, masked_path, version, keys).collect())  # quarters, or the like
    todo = found[:at_most]
    for at in range(0, len(todo), together):
        some = [reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(keys, part)]) for part in todo[at : at + together]]
        rows = masking.remask(raw.filter(reduce(lambda a, b: a | b, some)), config, salt, version)
        (
            rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys).parquet(masked_path)
        )
    return todo


def read_masked(spark: SparkSession, masked_path: str, schema: T.StructType) -> DataFrame:
    """The masked table; ``schema`` is that of the raw one."""
    return read_or_empty(spark, masked_path, T.StructType([*schema.fields, T.StructField("masking_version", T.StringType())]))
