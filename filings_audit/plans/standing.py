"""Answers from the counts per month: the summary reads no record, the newest records come from the months that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filings_audit.operators import triage
from filings_audit.sinks import gold, months


def month_facts(spark: SparkSession, root: str) -> DataFrame:
    """The counts of every current month. Months of a table from before counts were kept are counted now."""
    current = gold.current_folders(spark, root)
    known = months.noted(spark, root)
    kept = known.join(current, "location", "left_semi")
    lacking = [r.location for r in current.join(known, "location", "left_anti").select("location").collect()]  # calendar months
    return kept.unionByName(months.count(gold.read_folders(spark, root, lacking))) if lacking else kept


def summary(spark: SparkSession, root: str, with_average: bool = False) -> DataFrame:
    """A1, A2, X2 over the whole table: the same row as ``triage.summary``."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "violations", "anomalies", "healthy")]
    if with_average:
        average = F.sum("score_sum").cast("double") / F.nullif(F.sum("scored"), F.lit(0))
        totals.append(F.round(average, 6).alias("average_score"))
    return month_facts(spark, root).agg(*totals)


def newest(spark: SparkSession, root: str, limit: int = triage.DEFAULT_LIMIT) -> DataFrame:
    """The same rows as ``triage.newest``, from the months that can hold them.

    Months whose oldest rows are the latest are counted until they hold ``limit`` rows: no row older than the last of these
    months can be among the newest, nor can a month without later rows.
    """
    limit = triage.bounded(limit, triage.FILING_LIMITS)
    spans = month_facts(spark, root).select("location", "total", "oldest", "newest").collect()  # calendar months
    bound, rows = None, 0
    for span in sorted(spans, key=lambda s: -s.oldest):
        rows += span.total
        if rows >= limit:
            bound = span.oldest
            break
    table = gold.read_folders(spark, root, [s.location for s in spans if bound is None or s.newest >= bound])
    if bound is not None:
        table = table.filter(F.col("created_at") >= F.timestamp_micros(F.lit(bound)))
    return triage.newest(table.drop("location"), limit)
