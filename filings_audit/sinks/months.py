"""Counts per month, kept beside the triage table, so that summaries and the newest rows need not read it.

A commit counts the month folders it has written, on their narrow columns alone, before the log names them. Such a folder
never changes, so neither does its row here; rows of folders that the log doesn't name are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.sources.tables import read_or_empty

FACTS = T.StructType([
    T.StructField("location", T.StringType()),
    *[T.StructField(name, T.LongType()) for name in ("total", "violations", "anomalies", "healthy", "scored")],
    T.StructField("score_sum", T.DecimalType(38, 4)),  # exact, so that sums of sums are the sum
    *[T.StructField(name, T.LongType()) for name in ("oldest", "newest")],  # microseconds
])


def count(rows: DataFrame) -> DataFrame:
    """One row per ``location``: what A1, A2 and X2 count, and between which times its rows were made."""
    rule, ml, score = F.col("known_rule_violation"), F.col("ml_anomaly_flag"), F.col("ml_anomaly_score")
    made = F.unix_micros("created_at")
    return rows.groupBy("location").agg(
        F.count("*").alias("total"), F.count_if(rule).alias("violations"), F.count_if(ml).alias("anomalies"),
        F.count_if(~rule & ~ml).alias("healthy"), F.count(score).alias("scored"),
        F.coalesce(F.sum(score.cast("decimal(10,4)")), F.lit(0)).cast("decimal(38,4)").alias("score_sum"),
        F.min(made).alias("oldest"), F.max(made).alias("newest"),
    )


def note(rows: DataFrame, root: str, version: int) -> None:
    """Keep the counts of the folders of a commit; a writer that died before it named them has its counts replaced."""
    count(rows).select(*FACTS.names).coalesce(1).write.mode("overwrite").parquet(f"{root}/months/commit={version}")


def noted(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/months", FACTS).select(*FACTS.names)
