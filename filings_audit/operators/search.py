"""Search of names by an inverted table of trigrams, in place of a scan of all names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Around each name, so that names and searches of one or two characters have trigrams too.
EDGE = "\x02\x02"
SIZE = 3
# Trigrams of a search that are intersected: the rarest.
MOST = 4


def _grams(text: Column) -> Column:
    padded = F.concat(F.lit(EDGE), F.lower(text), F.lit(EDGE))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - SIZE + 1), lambda at: F.substr(padded, at, F.lit(SIZE))))


def write_index(rows: DataFrame, path: str, name: str = "company_name", part: str = "filing_month") -> None:
    """A row per trigram and distinct name, whatever the case, in the order of trigrams, with a count of each; and a row per
    name and partition that holds it.

    A name is cut once, however many records have it. A trigram that nearly all names hold is spread over files by name.
    Null names can't be found and have no row.
    """
    spark = rows.sparkSession
    named = rows.filter(F.col(name).isNotNull()).select(F.lower(name).alias("name"), F.col(part).alias("part"))
    named.distinct().write.mode("overwrite").parquet(f"{path}/names")
    names = spark.read.parquet(f"{path}/names").select("name").distinct()
    grams = names.select(F.explode(_grams(F.col("name"))).alias("gram"), "name")
    grams.repartitionByRange("gram", "name").sortWithinPartitions("gram", "name").write.mode("overwrite").parquet(f"{path}/grams")
    stored = spark.read.parquet(f"{path}/grams")
    stored.groupBy("gram").agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The lower-case names that hold the trigrams of the text, a superset of what is looked for."""
    wanted = text.lower()
    counts, grams = spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/grams")
    if len(wanted) < SIZE:  # the trigrams around it: bounded by the alphabet, not by the rows
        near = counts.filter(F.col("gram").contains(wanted)).select("gram")
        return grams.join(near, "gram", "left_semi").select("name").distinct()
    cut = sorted({wanted[i : i + SIZE] for i in range(len(wanted) - SIZE + 1)})
    known = {r.gram: r.n for r in counts.filter(F.col("gram").isin(cut)).collect()}  # one per trigram of the text
    if len(known) < len(cut):  # a trigram that no name has
        return grams.select("name").limit(0)
    rarest = sorted(cut, key=lambda g: (known[g], g))[:MOST]
    found = grams.filter(F.col("gram").isin(rarest)).groupBy("name").agg(F.count("*").alias("n"))
    return found.filter(F.col("n") == len(rarest)).select("name")


def search(table: DataFrame, path: str, text: str, name: str = "company_name", part: str = "filing_month") -> DataFrame:
    """Rows whose name contains the text, whatever the case; ``%`` and ``_`` stand for themselves, an empty text for all.

    Only candidates are compared, each name once, and only the partitions that hold a name which contains the text are read.
    """
    if not text:
        return table
    spark = table.sparkSession
    found = candidates(spark, path, text).filter(F.col("name").contains(text.lower()))
    places = spark.read.parquet(f"{path}/names").join(found, "name", "left_semi")
    parts = [r.part for r in places.select("part").distinct().collect()]  # one per partition of the table
    same = F.lower(table[name]) == found["name"]
    return table.filter(F.col(part).isin(parts)).join(found, same, "left_semi").select(*table.columns)
