"""Keyed operators that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark keeps the best row of each key in every map task before the shuffle, so a hot key sends one
    row per task. ``order`` should end in a column that breaks every tie.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def previous_value(df: DataFrame, key: str, day: str, order: str, value: str, out: str) -> DataFrame:
    """``lag(value)`` per key in (day, order), without putting a whole key into one task.

    Rows are ranked within (key, day); the first row of a day takes the closing value of the key's
    previous day, found on the far smaller table of daily closes.
    """
    within = Window.partitionBy(key, day).orderBy(order)
    days = df.groupBy(key, day).agg(F.max_by(value, order).alias("__close"))
    opening = days.select(
        key, day, F.lag("__close").over(Window.partitionBy(key).orderBy(day)).alias("__open")
    )
    ranked = df.withColumns({"__before": F.lag(value).over(within), "__rank": F.row_number().over(within)})
    return (
        ranked.join(opening, [key, day], "left")
        .withColumn(out, F.when(F.col("__rank") == 1, F.col("__open")).otherwise(F.col("__before")))
        .drop("__before", "__rank", "__open")
    )


def attach_facts(filings: DataFrame, facts: DataFrame, key: str = "cik") -> DataFrame:
    """Left join to a facts table that has one row per key.

    No hint: Spark broadcasts the facts only when their size allows, and adaptive execution splits a
    filing partition that a hot key overfills.
    """
    return filings.join(facts, key, "left")


def join_on_masked(left: DataFrame, right: DataFrame, left_hash: str, right_hash: str) -> DataFrame:
    """Join two masked tables on equal hashes. ``right`` must hold each hash once."""
    return left.join(right, F.col(left_hash) == F.col(right_hash), "inner")


def without_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not listed."""
    return df.join(ids.select(key), key, "left_anti")
