"""Connected components of an edge table, labelled by their smallest vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filings_audit.session import materialize


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` for every vertex of the edges (columns u, v, both long and not null).

    Alternates two steps until nothing changes: every vertex hands its larger neighbours to the smallest vertex it
    sees, then its smaller ones. Each step is an aggregation and a join; the edges never grow in number. Loops and
    repeated edges do no harm; isolated vertices appear only if they have a loop. No edge: no rows.
    """
    given = edges.select("u", "v")
    now = materialize(given.where("u != v").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("root"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        large = materialize(large.where("u != v").distinct(), "edges")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("root"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("root").alias("v")).unionByName(least.withColumnRenamed("root", "v"))
        now = materialize(small.where("u != v").distinct(), "edges")
    found = now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    roots = found.select("component").distinct().select(F.col("component").alias("vertex"), "component")
    loops = given.where("u = v").select(F.col("u").alias("vertex"), F.col("u").alias("component"))
    alone = loops.distinct().join(found.select("vertex").unionByName(roots.select("vertex")), "vertex", "left_anti")
    return found.unionByName(roots).unionByName(alone)
