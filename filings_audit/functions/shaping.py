"""Display fields of a triage record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filings_audit.functions.identity import md5_mod
from filings_audit.functions.scores import decimal_text

# The reviewer roster, in routing order.
ASSIGNEES = [
    "Sarah M.", "James K.", "Emily R.", "David L.",
    "Karen T.", "Michael B.", "Alice C.", "Thomas W.",
]
# Display ranks; anything else ranks 9.
SEVERITY_RANK = {"violation": 0, "anomaly": 1, "healthy": 2}
STATUS_RANK = {"Needs Review": 0, "In Progress": 1, "Resolved": 2}

MODEL_VERSION = "IsoForest-v2.4"
URGENT_DAYS = 2


def _by_flag(rule: Column, ml: Column, on_rule: str, on_ml: str, otherwise: str) -> Column:
    return F.when(rule, F.lit(on_rule)).when(ml, F.lit(on_ml)).otherwise(F.lit(otherwise))


def issue_type(rule: Column, ml: Column) -> Column:
    """the rule outranks the model."""
    return _by_flag(rule, ml, "Rule Violation", "ML Anomaly", "None")


def severity(rule: Column, ml: Column) -> Column:
    return _by_flag(rule, ml, "violation", "anomaly", "healthy")


def review_status(rule: Column, ml: Column) -> Column:
    return _by_flag(rule, ml, "Needs Review", "In Progress", "Resolved")


def needs_triage(rule: Column, ml: Column) -> Column:
    """F10."""
    return F.coalesce(rule, F.lit(False)) | F.coalesce(ml, F.lit(False))


def workflow_status(rule: Column, ml: Column) -> Column:
    """the two-valued status used by the intake feed."""
    return F.when(needs_triage(rule, ml), F.lit("Pending")).otherwise(F.lit("Resolved"))


def _rank(value: Column, ranks: dict[str, int]) -> Column:
    chain = F
    for label, rank in ranks.items():
        chain = chain.when(value == label, F.lit(rank))
    return chain.otherwise(F.lit(9))


def severity_rank(value: Column) -> Column:
    """T4."""
    return _rank(value, SEVERITY_RANK)


def status_rank(value: Column) -> Column:
    """T4."""
    return _rank(value, STATUS_RANK)


def routing_number(record_id: Column) -> Column:
    """The leading number of an id, or a stable hash in [0, 10000) when it has none."""
    head = F.split_part(record_id, F.lit("-"), F.lit(1))
    number = F.when(head.rlike("^[0-9]{1,38}$"), head.try_cast("decimal(38,0)"))
    return F.coalesce(number, md5_mod(record_id, 10000).cast("decimal(38,0)"))


def assignee(record_id: Column) -> Column:
    """reviewer by id, round the roster."""
    roster = F.array(*[F.lit(name) for name in ASSIGNEES])
    seat = (routing_number(record_id) % len(ASSIGNEES)).cast("int")
    return F.element_at(roster, seat + 1)


def alert_age_hours(record_id: Column, score: Column) -> Column:
    """deterministic age in [1, 192] hours."""
    return F.greatest(F.lit(1), (md5_mod(record_id, 1000) * 11 + (score * 137).cast("int")) % 193)


def age_token(hours: Column) -> Column:
    """``Nh`` below a day, else whole days ``Nd``."""
    days = F.floor(hours / 24).cast("string")
    return F.when(hours < 24, F.concat(hours.cast("string"), F.lit("h"))).otherwise(F.concat(days, F.lit("d")))


def token_hours(token: Column) -> Column:
    """Hours of an age token; anything else is 0."""
    number = F.regexp_extract(token, r"^(\d+)[hd]$", 1).try_cast("int")
    return F.coalesce(
        F.when(token.endswith("h"), number).when(token.endswith("d"), number * 24), F.lit(0)
    )


def is_urgent(token: Column) -> Column:
    """at least two days old."""
    return token_hours(token) >= URGENT_DAYS * 24


def billions_text(amount: Column) -> Column:
    """``$x.yB``; null stays null."""
    return F.concat(F.lit("$"), decimal_text(amount.cast("decimal(20,2)") * F.lit("0.000000001").cast("decimal(10,9)"), 1), F.lit("B"))


def cash_ratio(amount: Column) -> Column:
    """amount over ten billion, 3 decimals, 0 when missing."""
    tenth = F.lit("0.0000000001").cast("decimal(11,10)")
    exact = F.round(F.coalesce(amount.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)")) * tenth, 3)
    return exact.cast("decimal(20,3)").cast("double")


def date_text(day: Column) -> Column:
    """F15."""
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("N/A"))


def or_not_available(text: Column) -> Column:
    """F16."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("N/A"))


def rounded3(value: Column) -> Column:
    return F.round(F.coalesce(value, F.lit(0.0)).cast("decimal(30,10)"), 3).cast("double")


def feature_contributions(growth: Column, cash_flow: Column, score: Column) -> Column:
    """the three named contributions. ``filingFrequency`` is a fixed share of the score (heuristic)."""
    share = F.round(score.cast("decimal(10,4)") * F.lit("0.3").cast("decimal(2,1)"), 3).cast("double")
    return F.struct(
        rounded3(growth).alias("revenueGrowthDelta"),
        cash_ratio(cash_flow).alias("cashFlowRatio"),
        share.alias("filingFrequency"),
    )


def top_feature(contributions: Column) -> Column:
    """Name of the contribution largest in absolute value; ties go to the first declared."""
    names = ["revenueGrowthDelta", "cashFlowRatio", "filingFrequency"]
    sizes = [F.abs(contributions.getField(name)) for name in names]
    largest = F.greatest(*sizes)
    chain = F
    for name, size in zip(names, sizes):
        chain = chain.when(size == largest, F.lit(name))
    return chain


def percent_text(value: Column) -> Column:
    """A ratio as ``12.3%``; null stays null."""
    return F.concat(decimal_text(value.cast("decimal(28,10)") * 100, 1), F.lit("%"))


def dollars_text(amount: Column) -> Column:
    """``$1,234.50``; the sign goes before the dollar."""
    return F.concat(
        F.when(amount < 0, F.lit("-$")).otherwise(F.lit("$")), F.format_number(F.abs(amount), 2)
    )
