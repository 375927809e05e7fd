"""Rule, scalar statistics, thresholds and the two-layer flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.functions.scores import min_max, no_nan, scaled_cash_flow, z_score

GROWTH_LIMIT = 0.20
# Distinct values among which a quantile is picked on the driver.
LAST_VALUES = 10_000
# Items of a sketch's top level, and thrice the error of its ranks (2.296 / k ** 0.9021 with 99 % confidence).
SKETCH = 4096
MARGIN = 3 * 2.296 / SKETCH**0.9021


def rule_violation(growth: Column, cash_flow: Column) -> Column:
    """Growth above 20% on negative cash flow; missing values never violate."""
    return (F.coalesce(no_nan(growth), F.lit(0.0)) > GROWTH_LIMIT) & (
        F.coalesce(cash_flow, F.lit(0)) < 0
    )


def scalar(df: DataFrame, **aggregates: Column) -> dict[str, Column]:
    """Aggregates of ``df`` as scalar subqueries, to use in any other plan."""
    value = df.agg(F.struct(*[expr.alias(name) for name, expr in aggregates.items()]).alias("value")).scalar()
    return {name: value.getField(name) for name in aggregates}


def with_features(df: DataFrame) -> DataFrame:
    """The z-score of growth and the scaled cash flow."""
    growth = scalar(df, mean=F.avg("revenue_growth"), std=F.stddev_samp("revenue_growth"))
    return df.withColumns(
        {
            "revenue_growth_norm": z_score(F.col("revenue_growth"), growth["mean"], growth["std"]),
            "operating_cash_flow_norm": scaled_cash_flow(F.col("operating_cash_flow")),
        }
    )


def sketches(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """(by, n, sketch) of the finite values of ``column``; partial in every task, so no value is shuffled.

    Stored per partition of a growing table, they are merged to any union of partitions; a new one reads only itself.
    """
    value = F.col(column).cast("double")
    fine = df.select(*(by or []), F.when(~F.isnan(value), value).alias("v")).filter(F.col("v").isNotNull())
    return fine.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", SKETCH).alias("sketch"))


def _bounds(sketch: DataFrame, place: float, n: int, margin: float) -> tuple[float, float]:
    """Values with the wanted place most likely between them; infinite at the ends."""
    low, high = place / n - margin, (place + 1) / n + margin
    at = lambda share: F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, share))))
    found = sketch.select(at(low).alias("low"), at(high).alias("high")).first()
    return (found.low if low > 0 else float("-inf")), (found.high if high < 1 else float("inf"))


def quantile(df: DataFrame, column: str, share: float, stored: DataFrame | None = None) -> DataFrame:
    """Exact quantile with linear interpolation, as a one-row DataFrame; null without values, NaN is none.

    A sketch (merged from ``stored`` ones where given) bounds the wanted value from both sides; what lies between is
    sketched again until it is few values, which are counted, and nothing is rounded. Counts of what lies below the
    bounds prove them; bounds that miss are widened. Only the last few distinct values are shuffled.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    spark = df.sparkSession
    if stored is None:
        stored = sketches(df, column)
    whole = stored.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).first()
    n, found = whole.n or 0, None
    place = (n - 1) * share
    before, size, sketch, margin = 0, n, whole.sketch, MARGIN
    low, high = float("-inf"), float("inf")
    while n:
        one = spark.createDataFrame([(sketch,)], "sketch binary")
        inner = _bounds(one, place - before, size, margin)
        inner = max(low, inner[0]), min(high, inner[1])
        at_most = values.filter(F.col("v") <= inner[1])
        if 2 * margin * size + 2 <= LAST_VALUES or inner == (low, high):
            # Values below the bounds are one group, counted in the same job.
            counts = at_most.groupBy(F.when(F.col("v") >= inner[0], F.col("v")).alias("v")).count().limit(LAST_VALUES + 2).collect()
            below = sum(r["count"] for r in counts if r["v"] is None)
            few = sorted((r["v"], r["count"]) for r in counts if r["v"] is not None)
            inside = sum(k for _, k in few)
            if len(few) <= LAST_VALUES and _covers(place, below, inside, n):
                found = _pick(few, place - below)
                break
            if inner == (low, high) and len(few) > LAST_VALUES and margin >= 1:
                raise ValueError(f"more than {LAST_VALUES} values can't be told apart")
            margin = min(1.0, 2 * margin)
            continue
        inside = F.when(F.col("v") >= inner[0], F.col("v"))
        row = at_most.agg(F.count("*").alias("all"), F.count(inside).alias("size"), F.kll_sketch_agg_double(inside, SKETCH).alias("sketch")).first()
        if not _covers(place, row["all"] - row["size"], row["size"], n):
            margin = min(1.0, 2 * margin)
            continue
        (low, high), before, size, sketch, margin = inner, row["all"] - row["size"], row["size"], row["sketch"], MARGIN
    return spark.createDataFrame([(found,)], "threshold double")


def _covers(place: float, before: int, size: int, n: int) -> bool:
    """Whether the value at a place, and the next one if there is any, is among ``size`` values that follow ``before``."""
    return before <= int(place) and before + size >= min(n, int(place) + (2 if place > int(place) else 1))


def _pick(counts: list[tuple[float, int]], place: float) -> float:
    """The value at a fractional place of a sorted list given as values and their counts."""
    lower, upper, seen = None, None, 0
    first = int(place)
    for value, n in counts:
        seen += n
        if lower is None and seen > first:
            lower = value
        if upper is None and (seen > first + 1 or place == first and lower is not None):
            upper = value
    upper = counts[-1][0] if upper is None else upper
    return lower + (upper - lower) * (place - first)


def flag_below_quantile(df: DataFrame, raw: str = "ml_raw_score", contamination: float = 0.01) -> DataFrame:
    """Flag rows whose raw score lies below its ``contamination`` quantile."""
    threshold = quantile(df, raw, contamination).scalar()
    return df.withColumn("ml_anomaly_flag", F.coalesce(F.col(raw) < threshold, F.lit(False)))


def normalise_scores(df: DataFrame, raw: str = "ml_raw_score") -> DataFrame:
    """Raw scores turned to [0, 1], 1 the most anomalous."""
    bounds = scalar(df, low=F.min(-F.col(raw)), high=F.max(-F.col(raw)))
    return df.withColumn("ml_anomaly_score", min_max(-F.col(raw), bounds["low"], bounds["high"]))


def with_rule(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "known_rule_violation", rule_violation(F.col("revenue_growth"), F.col("operating_cash_flow"))
    )


def live_flags(df: DataFrame, contamination: float = 0.08, raw: str = "ml_raw_score") -> DataFrame:
    """Rule, model flag and normalised score over given raw scores."""
    return normalise_scores(flag_below_quantile(with_rule(df), raw, contamination), raw)


def dual_layer(df: DataFrame, contamination: float = 0.01, raw: str = "ml_raw_score") -> DataFrame:
    """Both flags and their sum as triage priority."""
    flagged = flag_below_quantile(with_rule(df), raw, contamination)
    return flagged.withColumn(
        "triage_priority", F.col("known_rule_violation").cast("int") + F.col("ml_anomaly_flag").cast("int")
    )


def detection_summary(df: DataFrame) -> DataFrame:
    """A9."""
    return df.agg(
        F.count("*").alias("records"),
        F.count_if("known_rule_violation").alias("rule_violations"),
        F.count_if("ml_anomaly_flag").alias("ml_anomalies"),
    )


def late_filing(period_end: Column, filed: Column, limit_days) -> Column:
    """Filed more than the allowed days after the period's end."""
    limit = limit_days if isinstance(limit_days, Column) else F.lit(limit_days)
    return F.datediff(filed, period_end) > limit
