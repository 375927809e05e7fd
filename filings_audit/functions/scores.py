"""Arithmetic on features and anomaly scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9  # keeps both normalisations finite on constant input
CASH_FLOW_SCALE = 1e10


def no_nan(value: Column) -> Column:
    """NaN to null. Spark orders NaN above every number, so it must not reach a comparison."""
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """F3."""
    return (value - mean) / (std + EPSILON)


def scaled_cash_flow(value: Column) -> Column:
    """F4."""
    return F.coalesce(value.cast("double"), F.lit(0.0)) / CASH_FLOW_SCALE


def min_max(score: Column, low: Column, high: Column) -> Column:
    """position of ``score`` in its range, 4 decimals."""
    return F.round((score - low) / (high - low + EPSILON), 4)


def risk_cluster(score: Column) -> Column:
    """F6."""
    return (
        F.when(score >= 0.8, F.lit("Cluster-7 (High-Risk)"))
        .when(score >= 0.5, F.lit("Cluster-3 (Medium-Risk)"))
        .otherwise(F.lit("Cluster-2 (Low-Risk)"))
    )


def score_interval(score: Column) -> tuple[Column, Column, Column]:
    """F8: lower bound, upper bound and the text ``lo – hi``. A fixed ±0.04 band, not a fitted interval."""
    exact = score.cast("decimal(10,4)")
    band = F.lit("0.04").cast("decimal(10,4)")
    low = F.round(F.greatest(F.lit(0).cast("decimal(10,4)"), exact - band), 2).cast("decimal(10,2)")
    high = F.round(F.least(F.lit(1).cast("decimal(10,4)"), exact + band), 2).cast("decimal(10,2)")
    text = F.concat(low.cast("string"), F.lit(" – "), high.cast("string"))
    return low, high, text


def decimal_text(value: Column, places: int) -> Column:
    """A number as text with ``places`` decimals, rounded half up in decimal arithmetic."""
    return F.round(value.cast("decimal(30,10)"), places).cast(f"decimal(30,{places})").cast("string")
