"""Bronze, silver and export files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.schemas import BRONZE, SILVER, conform

Watch = Callable[[DataFrame], DataFrame]


def unwatched(df: DataFrame) -> DataFrame:
    return df


def month_of(day: str):
    return F.date_format(F.col(day), "yyyy-MM")


def write_bronze(df: DataFrame, path: str, watch: Watch = unwatched) -> None:
    """K1: replaces only the quarters in ``df``. Rows are spread so that no quarter is one task. ``watch`` may observe the rows as
    they are written."""
    (
        watch(conform(df, BRONZE).hint("rebalance", "edgar_year", "edgar_quarter"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("edgar_year", "edgar_quarter").parquet(path)
    )


def write_silver(df: DataFrame, path: str, watch: Watch = unwatched) -> None:
    """K2: the declared columns; of a frame that has quarters only these quarters are replaced."""
    quarters = [c for c in ("edgar_year", "edgar_quarter") if c in df.columns]
    rows = conform(df, T.StructType([*SILVER.fields, *[T.StructField(c, T.StringType()) for c in quarters]]))
    watch(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*quarters).parquet(path)


def write_by_form_and_month(df: DataFrame, path: str) -> None:
    """One folder per form and filing month."""
    (
        df.withColumn("filing_month", month_of("filing_date")).hint("rebalance", "form_type", "filing_month")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("form_type", "filing_month").parquet(path)
    )


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Filtered rows as CSV (with header), Parquet or JSON files."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    elif fmt in ("parquet", "json"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")
