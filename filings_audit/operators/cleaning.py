"""Projection, typing and defaulting of raw filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.functions.scores import no_nan
from filings_audit.schemas import MINIMIZED_COLUMNS

TARGET_FORMS = ("10-K", "10-Q", "8-K")
DEFAULT_DATE = "1900-01-01"
# Shapes of full dates and how each is read.
DATE_FORMS = {
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}": "yyyy-MM-dd",
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$": "MMM d, yyyy",
}
PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
MASKING_VERSION = "sha256-v1"
RECORD_CAP = 500


def minimize_columns(df: DataFrame) -> DataFrame:
    """Keep only what later stages need."""
    return df.select(*MINIMIZED_COLUMNS)


def to_triage_names(df: DataFrame) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed({"filing_id": "id", "revenue_usd": "operating_cash_flow"})


def only_forms(df: DataFrame, forms=TARGET_FORMS) -> DataFrame:
    """P3."""
    return df.filter(F.col("form_type").isin(*forms))


def drop_null_keys(df: DataFrame) -> DataFrame:
    """P4."""
    return df.dropna(subset=["company_name", "cik"])


def cap_records(df: DataFrame, limit: int = RECORD_CAP, order=("cik", "date_filed", "filename")) -> DataFrame:
    """P5: the first ``limit`` rows in a stated order (files have none of their own)."""
    return df.orderBy(*order).limit(limit)


def with_lineage(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """P6."""
    return df.withColumns(
        {
            "ingestion_ts": F.current_timestamp() if as_of is None else as_of,
            "masking_version": F.lit(MASKING_VERSION),
            "pii_masked": F.lit(True),
        }
    )


def with_lineage_struct(df: DataFrame, source: str, as_of: Column, version: str = MASKING_VERSION) -> DataFrame:
    """X7."""
    return df.withColumn(
        "data_lineage",
        F.struct(F.lit(source).alias("source"), as_of.alias("ingestion_ts"), F.lit(version).alias("masking_version")),
    )


def with_batch_tags(df: DataFrame, year: str, quarter: str) -> DataFrame:
    """P7."""
    return df.withColumns({"edgar_year": F.lit(year), "edgar_quarter": F.lit(quarter)})


def with_run_id(df: DataFrame, run_id: str) -> DataFrame:
    """One identity per run, chosen by the caller on the driver."""
    return df.withColumn("source_file_id", F.lit(run_id))


def money(value: Column) -> Column:
    """NaN to null, rounded to cents."""
    return no_nan(value).cast("decimal(20,2)")


def strip_cik(cik: Column) -> Column:
    """P9."""
    return F.regexp_replace(F.trim(cik), "^0+", "")


def company_or_unknown(name: Column) -> Column:
    """P10."""
    return F.trim(F.coalesce(name, F.lit("Unknown")))


def parse_date(text: Column) -> Column:
    """Full dates in the usual forms; bad, partial or missing ones become the default date, never an error."""
    plain = F.trim(text)
    found = [
        F.when(plain.rlike(shape), F.to_date(F.try_to_timestamp(F.substr(plain, F.lit(1), F.lit(10)) if "T" in shape else plain, F.lit(form)))) for shape, form in DATE_FORMS.items()
    ]
    return F.coalesce(*found, F.lit(DEFAULT_DATE).cast("date"))


def to_number(text: Column) -> Column:
    """Plain decimal numbers, with or without an exponent; all else, infinities and NaN become null."""
    value = F.when(F.trim(text).rlike(PLAIN_NUMBER), F.trim(text).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def clean_bronze(df: DataFrame, *keep: str) -> DataFrame:
    """Bronze to typed silver columns (P8-P12), and the columns of ``keep``."""
    return df.select(
        company_or_unknown(F.col("company_name")).alias("company_name"),
        parse_date(F.col("date_filed")).alias("filing_date"),
        "cik",
        "form_type",
        to_number(F.col("revenue_growth").cast("string")).alias("revenue_growth"),
        F.col("operating_cash_flow").try_cast("decimal(20,2)").alias("operating_cash_flow"),
        "revenue_usd",
        "executive_name",
        *keep,
    )
