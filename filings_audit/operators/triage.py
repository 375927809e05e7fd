"""The analyst's view: shape, filter, sort, page, count and look up triage records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.functions import scores, shaping
from filings_audit.session import materialize

PAGE_SIZE = 10
FILING_LIMITS = (1, 1000)
AUDIT_LIMITS = (1, 2000)
DEFAULT_LIMIT = 200
RANGE_ROWS = 100_000  # sort keys and ids that a task sorts for a page


def to_records(df: DataFrame) -> DataFrame:
    """triage rows as nested records."""
    rule = F.coalesce(F.col("known_rule_violation"), F.lit(False))
    ml = F.coalesce(F.col("ml_anomaly_flag"), F.lit(False))
    triage = shaping.needs_triage(rule, ml)
    score = F.coalesce(scores.no_nan(F.col("ml_anomaly_score")), F.lit(0.0))
    # ISO with the zone; a record that has no time gets the present.
    at = F.coalesce("created_at", F.current_timestamp()) if "created_at" in df.columns else F.current_timestamp()
    ingested = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    telemetry = F.struct(
        score.alias("anomalyScore"),
        scores.risk_cluster(score).alias("isolationCluster"),
        ingested.alias("ingestionTs"),
        F.lit(shaping.MODEL_VERSION).alias("modelVersion"),
        shaping.feature_contributions(F.col("revenue_growth"), F.col("operating_cash_flow"), score).alias("featureContrib"),
        scores.score_interval(score)[2].alias("confidenceInterval"),
    )
    extra = [c for c in ("created_at", "filing_month") if c in df.columns]
    return df.select(
        "id",
        F.coalesce(F.col("company_name"), F.lit("")).alias("company"),
        shaping.date_text(F.col("filing_date")).alias("filingDate"),
        shaping.issue_type(rule, ml).alias("issueType"),
        shaping.severity(rule, ml).alias("severity"),
        shaping.or_not_available(F.col("cik")).alias("cik"),
        shaping.or_not_available(F.col("form_type")).alias("formType"),
        shaping.billions_text(F.col("operating_cash_flow")).alias("revenue"),
        rule.alias("knownRuleViolation"),
        ml.alias("mlAnomalyFlag"),
        triage.alias("needsTriage"),
        shaping.review_status(rule, ml).alias("status"),
        F.when(triage, shaping.assignee(F.col("id"))).alias("assignee"),
        F.when(triage, shaping.age_token(shaping.alert_age_hours(F.col("id"), score))).alias("alertAge"),
        F.col("root_cause_message").alias("violationDetails"),
        telemetry.alias("mlTelemetry"),
        *extra,
    )


def as_json(records: DataFrame) -> DataFrame:
    """each record as one JSON text; sort helpers stay out of it."""
    fields = [c for c in records.columns if c not in ("created_at", "filing_month")]
    return records.select("id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def adapt_intake(df: DataFrame, row_number: Column) -> DataFrame:
    """intake rows, which lack growth and cash flow, in triage columns. Revenue stands in for cash flow."""
    return df.select(
        row_number.cast("string").alias("id"), "company_name", "filing_date", "cik", "form_type",
        F.lit(None).cast("double").alias("revenue_growth"),
        F.col("revenue_usd").alias("operating_cash_flow"),
        "known_rule_violation", "ml_anomaly_flag", "ml_anomaly_score", "root_cause_message",
        F.lit(None).cast("timestamp").alias("created_at"),
    )


@dataclass(frozen=True)
class TriageFilter:
    """Every part that is set must hold."""

    search: str = ""
    severity: str = "all"
    needs_review: bool = False
    date_from: date | None = None
    date_to: date | None = None
    rule: bool | None = None
    ml: bool | None = None


def apply_filter(df: DataFrame, wanted: TriageFilter) -> DataFrame:
    """Filter triage rows on stored columns, so that every condition can reach the file scan."""
    rule, ml = F.col("known_rule_violation"), F.col("ml_anomaly_flag")
    if wanted.needs_review:
        df = df.filter(rule | ml)
    if wanted.severity == "violation":
        df = df.filter(rule)
    elif wanted.severity == "anomaly":
        df = df.filter(~rule & ml)
    elif wanted.severity == "healthy":
        df = df.filter(~rule & ~ml)
    elif wanted.severity != "all":
        raise ValueError(f"unknown severity {wanted.severity!r}")
    if wanted.rule is not None:
        df = df.filter(rule == wanted.rule)
    if wanted.ml is not None:
        df = df.filter(ml == wanted.ml)
    if wanted.search:
        df = df.filter(F.lower("company_name").contains(wanted.search.lower()))
    for bound, inside in ((wanted.date_from, F.col("filing_date").__ge__), (wanted.date_to, F.col("filing_date").__le__)):
        if bound is not None:
            df = df.filter(inside(F.lit(bound)))
    if "filing_month" in df.columns:  # the date range also picks the partitions
        if wanted.date_from is not None:
            df = df.filter(F.col("filing_month") >= f"{wanted.date_from:%Y-%m}")
        if wanted.date_to is not None:
            df = df.filter(F.col("filing_month") <= f"{wanted.date_to:%Y-%m}")
    return df


def lookup(df: DataFrame, record_id: str) -> DataFrame:
    """Zero or one row."""
    return df.filter(F.col("id") == record_id).limit(1)


def bounded(limit: int, limits: tuple[int, int]) -> int:
    low, high = limits
    if not low <= limit <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    return limit


def newest(df: DataFrame, limit: int = DEFAULT_LIMIT, limits: tuple[int, int] = FILING_LIMITS) -> DataFrame:
    """Latest first; ties by id."""
    return df.orderBy(F.desc("created_at"), "id").limit(bounded(limit, limits))


def newest_audit(log: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """S6, T2."""
    return log.orderBy(F.desc("detection_ts"), "id").limit(bounded(limit, AUDIT_LIMITS))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


# What each sortable column of a record sorts by.
SORT_KEYS = {
    "company": lambda: F.col("company"),
    "formType": lambda: F.col("formType"),
    "filingDate": lambda: F.col("filingDate"),
    "issueType": lambda: shaping.severity_rank(F.col("severity")),
    "status": lambda: shaping.status_rank(F.col("status")),
    "anomalyScore": lambda: F.coalesce(F.col("mlTelemetry.anomalyScore"), F.lit(0.0)),
    "rootCause": lambda: _text("violationDetails"),
    "assignee": lambda: _text("assignee"),
    "alertAge": lambda: shaping.token_hours(F.col("alertAge")),
}
TEXT_KEYS = {"company", "formType", "filingDate", "rootCause", "assignee"}


def sort_keys(key: str | None, descending: bool = False, collation: str | None = None) -> list[tuple[Column, bool]]:
    """(column, descending) pairs of a record view. Ties stay newest first in both directions."""
    base = [(F.col("created_at"), True), (F.col("id"), False)]
    if key is None:
        return base
    value = SORT_KEYS[key]()
    if collation and key in TEXT_KEYS:
        value = F.collate(value, collation)
    return [(value, descending), *base]


def _order(keys: list[tuple[Column, bool]], reverse: bool = False) -> list[Column]:
    """Sort columns; reversing every direction also reverses where nulls go."""
    return [column.desc() if down != reverse else column.asc() for column, down in keys]


def sort_order(key: str | None, descending: bool = False, collation: str | None = None) -> list[Column]:
    return _order(sort_keys(key, descending, collation))


def sort_records(records: DataFrame, key: str | None, descending: bool = False, collation: str | None = None) -> DataFrame:
    return records.orderBy(*sort_order(key, descending, collation))


def clamp_page(page: int, rows: int, size: int = PAGE_SIZE) -> int:
    """T5: pages run from 1 to at least 1."""
    return max(1, min(page, -(-rows // size)))


def page(
    records: DataFrame, number: int, key: str | None = None, descending: bool = False,
    size: int = PAGE_SIZE, rows: int | None = None, collation: str | None = None, reach: int = RANGE_ROWS,
) -> DataFrame:
    """T5: one page of the sorted view, without a global numbering. Ids are unique.

    The first page is a top-k. Any other is found among the sort keys and ids alone: these are split into ranges of about
    ``reach`` rows and counted, the ranges that hold the page are sorted, and its records are read by their ids. The page
    number is clamped by the row count.
    """
    keys = sort_keys(key, descending, collation)
    if number <= 1:
        return records.orderBy(*_order(keys)).limit(size)
    rows = records.count() if rows is None else rows
    start = (clamp_page(number, rows, size) - 1) * size
    take = min(size, rows - start)
    if take <= 0:
        return records.limit(0)
    ids = _ids_between(records, keys, start, take, max(1, -(-rows // reach)))
    return records.join(F.broadcast(ids), "id", "left_semi").select(*records.columns).orderBy(*_order(keys))  # one page of ids


def _ids_between(records: DataFrame, keys: list[tuple[Column, bool]], start: int, take: int, ranges: int) -> DataFrame:
    """Ids of rows ``start .. start + take`` of the order. The driver gets one count per range.

    The ranges are written out, so that counting and reading see the same split.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    narrow = records.select("id", *[column.alias(name) for name, (column, _) in zip(names, keys)])
    order = _order([(F.col(name), down) for name, (_, down) in zip(names, keys)])
    stored = materialize(narrow.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "page")
    hit, before, skip = [], 0, 0
    for number, count in sorted(stored.groupBy("__range").count().collect()):
        if before < start + take and before + count > start:
            skip = skip if hit else start - before
            hit.append(number)
        before += count
    inside = stored.filter(F.col("__range").isin(hit))
    return inside.orderBy(*order).offset(skip).limit(take).select("id")


def summary(df: DataFrame, with_average: bool = False) -> DataFrame:
    """Counts over the whole table; healthy means neither flag."""
    rule, ml = F.col("known_rule_violation"), F.col("ml_anomaly_flag")
    totals = [
        F.count("*").alias("total"),
        F.count_if(rule).alias("violations"),
        F.count_if(ml).alias("anomalies"),
        F.count_if(~rule & ~ml).alias("healthy"),
    ]
    if with_average:
        # Scores have 4 decimals: summed exactly, the average does not depend on the partitioning.
        total = F.sum(F.col("ml_anomaly_score").cast("decimal(10,4)")).cast("double")
        totals.append(F.round(total / F.count("ml_anomaly_score"), 6).alias("average_score"))
    return df.agg(*totals)


def matching_count(df: DataFrame, wanted: TriageFilter) -> DataFrame:
    """A3."""
    return apply_filter(df, wanted).agg(F.count("*").alias("matching"))
