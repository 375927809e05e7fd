"""Checks that a Parquet table cannot make by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.schemas import TRIAGE, TRIAGE_KEY, TRIAGE_NOT_NULL, TRIAGE_REQUIRED


def require_columns(df: DataFrame, required=TRIAGE_REQUIRED) -> None:
    """K5: fails before any job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def with_defaults(df: DataFrame, as_of: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """K6: flags default to false, the creation time to now; only declared columns (and ``keep``) remain (K4)."""
    require_columns(df)
    have = set(df.columns)
    now = F.current_timestamp() if as_of is None else as_of
    defaults = {"known_rule_violation": F.lit(False), "ml_anomaly_flag": F.lit(False), "created_at": now}
    columns = []
    for field in TRIAGE.fields:
        value = F.col(field.name) if field.name in have else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        columns.append(value.alias(field.name))
    return df.select(*columns, *(keep or []))


def violations(not_null=TRIAGE_NOT_NULL) -> Column:
    """Names of the columns that break NOT NULL in a row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in not_null]))


def constraint_report(df: DataFrame, key: str = TRIAGE_KEY, not_null=TRIAGE_NOT_NULL) -> DataFrame:
    """K6: rows, duplicated keys and null counts in one job, pre-aggregated per key before the shuffle."""
    columns = [c for c in not_null if c in df.columns]
    per_key = df.groupBy(key).agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in columns],
    )
    return per_key.agg(
        F.sum("__rows").alias("records"),
        F.count_if((F.col("__rows") > 1) & F.col(key).isNotNull()).alias("duplicate_keys"),
        *[F.sum(f"__null_{c}").alias(f"null_{c}") for c in columns],
    )
