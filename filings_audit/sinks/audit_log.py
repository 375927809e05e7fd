"""The personal-data audit log and the event log."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filings_audit.operators.keyed import latest_per_key
from filings_audit.schemas import EVENT_LOG, PII_LOG, RUN_EVENTS, conform
from filings_audit.sources.tables import read_or_empty

logger = logging.getLogger(__name__)


def initialise(spark: SparkSession, path: str, schema=EVENT_LOG) -> None:
    """K7: create an empty table if the path is missing."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(path)


def write_pii_log(entries: DataFrame, path: str) -> int:
    """K8: append audit rows, one folder per source id, so that a repeated run replaces its own rows.

    Returns how many were written. There is at most one entry per source, column and type, so they pass
    through the driver. A failure is logged and returns 0: auditing never stops the run it audits.
    """
    rows = conform(entries, PII_LOG).collect()  # a failure to count is the run's own and goes on up
    if not rows:
        return 0
    broken = [r for r in rows if any(r[f.name] is None for f in PII_LOG.fields)]
    if broken:
        raise ValueError(f"{len(broken)} audit entries lack a required field")
    try:
        (
            entries.sparkSession.createDataFrame(rows, PII_LOG).coalesce(1)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_file_id").parquet(path)
        )
        return len(rows)
    except (PySparkException, Py4JError) as error:
        logger.warning("audit log not written to %s: %s", path, type(error).__name__)
        return 0


def read_pii_log(spark: SparkSession, path: str) -> DataFrame:
    """Empty when nothing was logged yet."""
    return read_or_empty(spark, path, PII_LOG).select(*PII_LOG.names)


def append_events(events: DataFrame, path: str) -> None:
    """X10."""
    conform(events, EVENT_LOG).write.mode("append").parquet(path)


class Step:
    """What one step of a run has written, per form type, counted by the write itself."""

    def __init__(self, event_type: str, forms: tuple[str, ...]):
        self.event_type, self.forms, self.seen = event_type, forms, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, to be written directly: counts of a stage that Spark repeats would be taken twice."""
        counts = [F.count_if(F.col("form_type") == form).alias(f"f{i}") for i, form in enumerate(self.forms)]
        return df.observe(self.seen, F.count("*").alias("all"), *counts)

    def counts(self) -> dict[str | None, int]:
        """Rows of each form that came, and of all others under None."""
        found = self.seen.get
        known = {form: found[f"f{i}"] for i, form in enumerate(self.forms)}
        return {form: n for form, n in {**known, None: found["all"] - sum(known.values())}.items() if n}


def write_run_events(spark: SparkSession, steps: list[Step], run_id: str, masking_version: str, at: Column, path: str) -> None:
    """An event per step and form. A run that is repeated writes the same ids: the later event counts."""
    rows = [(step.event_type, form, n) for step in steps for form, n in step.counts().items()]
    events = spark.createDataFrame(rows, "event_type string, form_type string, record_count long").withColumns({
        "log_id": F.md5(F.concat_ws("|", F.lit(run_id), "event_type", F.coalesce("form_type", F.lit("")))),
        "event_ts": at, "created_at": F.current_timestamp(), "pipeline_run_id": F.lit(run_id),
        "masking_version": F.when(F.col("event_type") == "MASK", F.lit(masking_version)),
    })
    month = F.date_format("event_ts", "yyyy-MM")
    conform(events, RUN_EVENTS).withColumn("event_month", month).coalesce(1).write.mode("append").partitionBy("event_month").parquet(path)


def read_run_events(spark: SparkSession, path: str) -> DataFrame:
    """The last event of each id; ``query_events`` filters them."""
    return latest_per_key(read_or_empty(spark, path, RUN_EVENTS).select(*RUN_EVENTS.names), "log_id", F.desc("created_at"))


@dataclass(frozen=True)
class EventFilter:
    event_type: str | None = None
    form_type: str | None = None
    since: datetime | None = None
    until: datetime | None = None


def _utc(moment: datetime) -> datetime:
    """A moment without a zone is meant in UTC, as stored."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def query_events(log: DataFrame, wanted: EventFilter = EventFilter()) -> DataFrame:
    """Every set part must hold."""
    if wanted.event_type is not None:
        log = log.filter(F.col("event_type") == wanted.event_type)
    if wanted.form_type is not None:
        log = log.filter(F.col("form_type") == wanted.form_type)
    if wanted.since is not None:
        log = log.filter(F.col("event_ts") >= F.lit(_utc(wanted.since)))
    if wanted.until is not None:
        log = log.filter(F.col("event_ts") <= F.lit(_utc(wanted.until)))
    return log
