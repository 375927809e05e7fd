"""Root-cause messages built from what was measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.functions.identity import md5_mod
from filings_audit.functions.scores import decimal_text

# What the rule has found: growth above its limit while operations lose cash.
RULE_TEXTS = [
    "Sales rose by more than a fifth while operations used up cash.",
    "Operating cash flow is below zero in a period of growth above the 20% limit; ask what has been collected.",
]
# What the model has found. Numbers of a message: growth, sigma, ratio, score.
MODEL_TEXTS = [
    "Score {score}: few random splits part this filing from the others.",
    "Growth is {sigma} standard deviations away from that of other filings ({growth}%).",
    "Cash flow ratio {ratio} at growth of {growth}% is a rare pair of values.",
    "Anomaly score {score} with growth of {growth}% and a cash flow ratio of {ratio}.",
]


def _fill(template: str, numbers: dict[str, Column]) -> Column:
    """``template`` with each ``{name}`` replaced by its column."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), numbers[name]]
    return F.concat(*pieces, F.lit(rest))


def _choose(options: list[Column], record_id: Column) -> Column:
    pick = md5_mod(record_id, len(options))
    chain = F
    for i, option in enumerate(options[:-1]):
        chain = chain.when(pick == i, option)
    return chain.otherwise(options[-1])


def root_cause(
    record_id: Column, rule: Column, ml: Column, growth: Column, sigma: Column, ratio: Column, score: Column
) -> Column:
    """A rule text, else a model text with the record's own numbers, else null.

    The text is chosen by the record's id, so a record keeps its message in every run.
    """
    zero = F.lit(0.0)
    numbers = {
        "growth": decimal_text(F.coalesce(growth, zero).cast("decimal(28,10)") * 100, 1),
        "sigma": decimal_text(F.abs(F.coalesce(sigma, zero)), 1),
        "ratio": decimal_text(F.coalesce(ratio, zero), 3),
        "score": decimal_text(score, 2),
    }
    rule_text = _choose([F.lit(text) for text in RULE_TEXTS], record_id)
    model_text = _choose([_fill(text, numbers) for text in MODEL_TEXTS], record_id)
    return F.when(rule, rule_text).when(ml, model_text)


def with_root_cause(df: DataFrame, record_id: str = "id") -> DataFrame:
    """Add ``root_cause_message`` from the columns that detection leaves."""
    return df.withColumn(
        "root_cause_message",
        root_cause(
            F.col(record_id), F.col("known_rule_violation"), F.col("ml_anomaly_flag"),
            F.col("revenue_growth"), F.col("revenue_growth_norm"),
            F.abs(F.col("operating_cash_flow_norm")), F.col("ml_anomaly_score"),
        ),
    )
