"""Declared schemas of every layer. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

MONEY = T.DecimalType(20, 2)


def _fields(spec: list[tuple[str, T.DataType]], required: frozenset[str] = frozenset()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in spec])


_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()

RAW = _fields(
    [
        ("filing_id", _S), ("form_type", _S), ("filing_date", T.DateType()), ("company_name", _S), ("cik", _S),
        ("executive_name", _S), ("executive_title", _S), ("revenue_usd", MONEY),
        ("internal_notes", _S), ("raw_submission_xml", _S), ("submitter_email", _S),
    ],
    frozenset({"filing_id", "form_type", "filing_date", "company_name", "cik"}),
)

# What survives data minimisation.
MINIMIZED_COLUMNS = [
    "filing_id", "form_type", "filing_date", "company_name", "cik",
    "executive_name", "executive_title", "revenue_usd",
]

BRONZE = _fields(
    [
        ("cik", _S), ("company_name", _S), ("form_type", _S), ("date_filed", _S), ("filename", _S),
        ("edgar_year", _S), ("edgar_quarter", _S),
        ("revenue_usd", MONEY), ("revenue_growth", _D), ("operating_cash_flow", MONEY), ("executive_name", _S),
    ]
)

SILVER = _fields(
    [
        ("id", _S), ("company_name", _S), ("filing_date", T.DateType()), ("cik", _S), ("form_type", _S),
        ("revenue_growth", _D), ("operating_cash_flow", MONEY), ("executive_name", _S),
        ("known_rule_violation", _B), ("ml_anomaly_flag", _B), ("ml_anomaly_score", _D), ("root_cause_message", _S),
    ]
)

TRIAGE = _fields(
    [
        ("id", _S), ("company_name", _S), ("filing_date", T.DateType()), ("cik", _S), ("form_type", _S),
        ("revenue_growth", _D), ("operating_cash_flow", MONEY),
        ("known_rule_violation", _B), ("ml_anomaly_flag", _B), ("ml_anomaly_score", _D),
        ("root_cause_message", _S), ("created_at", T.TimestampType()),
    ]
)
TRIAGE_KEY = "id"
TRIAGE_REQUIRED = ["id", "company_name", "filing_date"]
TRIAGE_NOT_NULL = ["id", "company_name", "filing_date", "known_rule_violation", "ml_anomaly_flag", "created_at"]

PII_LOG = _fields(
    [
        ("id", _S), ("source_file_id", _S), ("field_name", _S), ("pii_type", _S), ("masking_method", _S),
        ("detection_ts", T.TimestampType()), ("pipeline_mode", _S), ("record_count", T.LongType()),
    ]
)

EVENT_LOG = _fields(
    [
        ("log_id", _S), ("filing_id", _S), ("event_type", _S), ("event_ts", T.TimestampType()),
        ("executive_name_hash", _S), ("form_type", _S), ("revenue_usd", MONEY),
        ("masking_version", _S), ("pipeline_run_id", _S), ("created_at", T.TimestampType()),
    ]
)

# An event of a run speaks for many filings: it has no filing_id, and says how many.
RUN_EVENTS = T.StructType([*EVENT_LOG.fields, T.StructField("record_count", T.LongType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name, cast to its types; absent columns become null, extras go."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
