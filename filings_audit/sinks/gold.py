"""The triage table: one Parquet folder per filing month, and an append-only log that names the current folders.

A write puts its batch into files once, in a folder of its own, and works on these from then on (of a batch that is a table
already it copies only what is refused); it rewrites the months it touches and then appends one file to the log, so readers see all of it or none. Every row of a batch is
afterwards either in the table, replaced by a later row of the same id, or among the rejected rows with its reasons: the
log names the rejects of each commit, also of one that stores nothing. Counts come with the writes. One writer
at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.operators.keyed import latest_per_key
from filings_audit.schemas import TRIAGE
from filings_audit.session import file_system, path_exists
from filings_audit.sinks import months as month_counts
from filings_audit.sinks.constraints import violations, with_defaults
from filings_audit.sinks.layers import Watch, month_of, unwatched
from filings_audit.sources.tables import read_or_empty

# A row per commit and month it changed (a month without rows has no location), and per commit and folder of rejects,
# which has no month. ``batch`` tells batches apart by what was in them.
LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("filing_month", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("batch", T.StringType()),
])
STORED = T.StructType([*TRIAGE.fields, T.StructField("filing_month", T.StringType())])
REJECTED = T.StructType([*STORED.fields, T.StructField("violations", T.ArrayType(T.StringType()))])
CHECKED = T.StructType([*REJECTED.fields, T.StructField("refused", T.BooleanType())])


@dataclass(frozen=True)
class Written:
    """What became of a batch. ``kept`` rows are in the table."""

    version: int
    kept: int
    rejected: int


def _last(spark: SparkSession, root: str) -> DataFrame:
    log = read_or_empty(spark, f"{root}/log", LOG)
    return log.groupBy("filing_month").agg(F.max_by("location", "version").alias("location"), F.max("version").alias("version"))


def current_folders(spark: SparkSession, root: str) -> DataFrame:
    """The folder (``location``) of each month that has rows."""
    return _last(spark, root).filter("filing_month IS NOT NULL AND location IS NOT NULL").select("filing_month", "location")


def _current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Last version, and the folder of each month: one short string per calendar month."""
    found = _last(spark, root).collect()
    months = {r.filing_month: r.location for r in found if r.filing_month and r.location}
    return max((r.version for r in found), default=0), months


def _read(spark: SparkSession, root: str, locations: list[str]) -> DataFrame:
    if not locations:
        return spark.createDataFrame([], STORED)
    stored = spark.read.schema(STORED).option("basePath", f"{root}/data").parquet(*sorted(locations))
    return stored.select(*STORED.names)


def read_folders(spark: SparkSession, root: str, locations: list[str]) -> DataFrame:
    """The rows of these month folders, each with its ``location``."""
    commit = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(commit=\d+)/filing_month=[^/]*/[^/]*$", 1)
    if not locations:
        return _read(spark, root, []).withColumn("location", F.lit(None).cast("string"))
    stored = spark.read.schema(STORED).option("basePath", f"{root}/data").parquet(*sorted(locations))
    place = F.concat(F.lit(f"{root}/data/"), commit, F.lit("/filing_month="), F.col("filing_month"))
    return stored.select(*STORED.names, place.alias("location"))


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The current rows; empty when nothing was written yet (K7)."""
    return _read(spark, root, list(_current(spark, root)[1].values()))


def read_if_written(spark: SparkSession, root: str) -> DataFrame | None:
    version, months = _current(spark, root)
    return _read(spark, root, list(months.values())) if version else None


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """K6: every refused row of every commit, with its reasons. A batch that is written again refuses the same rows: only
    those of its last commit count. Rejects are joined with the log, so no list of folders passes through the driver."""
    log = read_or_empty(spark, f"{root}/log", LOG).filter(F.col("filing_month").isNull() & F.col("location").isNotNull())
    if log.isEmpty():
        return spark.createDataFrame([], REJECTED)
    last = log.withColumn("last", F.max("version").over(Window.partitionBy("batch"))).filter("version = last")
    rows = spark.read.schema(REJECTED).parquet(f"{root}/batches/*/refused=true")
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -3), "/", 1)  # of folder/refused=true/file
    rows = rows.select(*REJECTED.names, folder.alias("location"))
    return rows.join(last.select("location"), "location", "left_semi").select(*REJECTED.names)


def _put(rows: DataFrame, root: str, folder: str, only_refused: bool = False) -> tuple[DataFrame, dict]:
    """Write checked rows once, told apart by whether they are refused; the write counts them, also those it leaves out."""
    seen = Observation()
    columns = [c for c in rows.columns if c not in CHECKED.names]
    counted = rows.observe(
        seen, F.count_if(~F.col("refused")).alias("kept"), F.count_if("refused").alias("refused"),
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in columns],
    )
    wanted = counted.filter("refused") if only_refused else counted
    wanted.select(*CHECKED.names).write.partitionBy("refused").parquet(f"{root}/batches/{folder}")
    return rows.sparkSession.read.schema(CHECKED).parquet(f"{root}/batches/{folder}"), seen.get


def _check(
    batch: DataFrame, root: str, folder: str, as_of: Column | None, watch: Watch = unwatched, stored: bool = False
) -> tuple[DataFrame, dict]:
    """Evaluate the batch, once. What it holds, in any order, gives it a name. Rows of a ``stored`` batch are copied only if refused."""
    named = batch.withColumn("mark", F.pmod(F.xxhash64(*[c for c in TRIAGE.names if c in batch.columns]), F.lit(1 << 60)))
    defaults = with_defaults(named, as_of, keep=["mark"]).withColumn("filing_month", month_of("filing_date"))
    reasons = defaults.withColumn("violations", violations())
    checked = reasons.withColumn("refused", F.size("violations") > 0)
    found, counts = _put(watch(checked), root, folder, stored)
    return (checked.select(*CHECKED.names) if stored else found), counts


def _commit(
    spark: SparkSession, root: str, version: int, stored: dict[str, str], valid: DataFrame, kept: int,
    folder: str, rejects: list[str], refused: int, batch: str,
) -> Written:
    """Replace rows of the same ids, wherever they are stored, and rewrite the months this touches. ``valid`` is in files."""
    path = f"{root}/data/commit={version}"
    log: list[tuple] = [(version, None, name, batch) for name in rejects] or [(version, None, None, batch)]
    if kept:
        old = _read(spark, root, list(stored.values()))
        held = old.select("filing_month", "id").join(valid.select("id"), "id", "left_semi").select("filing_month")
        touched = sorted(r.filing_month for r in valid.select("filing_month").union(held).distinct().collect())
        rows = valid.select(*STORED.names)
        before = [stored[m] for m in touched if m in stored]
        if before:
            rows = rows.unionByName(_read(spark, root, before).join(valid.select("id"), "id", "left_anti").select(*STORED.names))
        # Large months are split over tasks, small ones share them.
        # The bloom filter lets a lookup by id (P16) skip files, which its month can't tell.
        writer = rows.hint("rebalance", "filing_month").write.mode("overwrite").option("parquet.bloom.filter.enabled#id", "true")
        writer.partitionBy("filing_month").parquet(path)
        places = {m: f"{path}/filing_month={m}" for m in touched}
        written = {m: place for m, place in places.items() if path_exists(spark, place)}
        month_counts.note(read_folders(spark, root, list(written.values())), root, version)
        log += [(version, m, written.get(m), batch) for m in touched]
    spark.createDataFrame(log, LOG).coalesce(1).write.mode("append").parquet(f"{root}/log")
    for name in (folder, f"{folder}-single", f"{folder}-again"):  # copies of what is now stored
        fs, target = file_system(spark, f"{root}/batches/{name}/refused=false")
        fs.delete(target, True)
    return Written(version, kept, refused)


def upsert(
    batch: DataFrame, root: str, as_of: Column | None = None, order: list[Column] | None = None, unique: bool = False,
    watch: Watch = unwatched, stored: bool = False,
) -> Written:
    """K3: rows of ``batch`` replace stored rows of the same id, also of other months. Doing it twice changes nothing.

    Of several batch rows with one id the first in ``order`` wins (the latest by default); ``unique`` says there are
    none and saves that shuffle. Rows that break a constraint are kept apart, see ``read_rejected``. ``watch`` may observe
    the rows that are checked. ``stored`` says that the batch is read from files which the write doesn't change: its valid rows
    are taken from there.
    """
    last, months = _current(batch.sparkSession, root)
    folder = uuid.uuid4().hex
    checked, counts = _check(batch, root, folder, as_of, watch, stored)
    valid, kept = checked.filter("NOT refused"), counts["kept"]
    if kept and not unique:
        order = order or [F.desc("created_at"), F.desc("company_name"), *[F.desc(c) for c in TRIAGE.names[2:-1]]]
        found, single = _put(latest_per_key(valid, "id", *order), root, f"{folder}-single")
        valid, kept = found.filter("NOT refused"), single["kept"]
    rejects = [folder] if counts["refused"] else []
    return _commit(batch.sparkSession, root, last + 1, months, valid, kept, folder, rejects, counts["refused"], _name(counts))


def append(batch: DataFrame, root: str, as_of: Column | None = None) -> Written:
    """K4: add rows; an id that is stored or comes again within the batch is refused, as a primary key would."""
    spark = batch.sparkSession
    last, stored = _current(spark, root)
    folder = uuid.uuid4().hex
    checked, counts = _check(batch, root, folder, as_of)
    known = _read(spark, root, list(stored.values())).select("id").withColumn("known", F.lit(True))
    place = F.row_number().over(Window.partitionBy("id").orderBy(*[F.desc(c) for c in TRIAGE.names[1:]]))
    ranked = checked.filter("NOT refused").withColumn("place", place).join(known, "id", "left")
    again = F.col("known").isNotNull() | (F.col("place") > 1)
    told = ranked.withColumns({"refused": again, "violations": F.when(again, F.array(F.lit("repeated id"))).otherwise(F.col("violations"))})
    found, single = _put(told.select(*CHECKED.names), root, f"{folder}-again")
    rejects = [name for name, n in ((folder, counts["refused"]), (f"{folder}-again", single["refused"])) if n]
    refused = counts["refused"] + single["refused"]
    # An append of the same rows is another batch: its rows are refused as repeated ones.
    return _commit(spark, root, last + 1, stored, found.filter("NOT refused"), single["kept"], folder, rejects, refused, folder)


def _name(counts: dict) -> str:
    return f"{counts['kept']}-{counts['refused']}-{counts['mark'] or 0}"


def initialise(spark: SparkSession, root: str) -> None:
    """K7: create the table if absent; harmless otherwise."""
    if not path_exists(spark, f"{root}/log"):
        spark.createDataFrame([], LOG).coalesce(1).write.parquet(f"{root}/log")
