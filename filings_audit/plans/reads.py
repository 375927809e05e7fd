"""What a client asks of the stored tables. Every answer covers the whole table, not a recent slice of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filings_audit.operators import triage
from filings_audit.operators.triage import TriageFilter
from filings_audit.plans import standing
from filings_audit.sinks.audit_log import read_pii_log
from filings_audit.sinks.gold import read_gold


class NotFound(LookupError):
    """No record has the id."""


def triage_view(
    table: DataFrame, wanted: TriageFilter = TriageFilter(), sort: str | None = None, descending: bool = False,
    page: int = 1, size: int = triage.PAGE_SIZE,
) -> DataFrame:
    """One page of shaped records: filter the stored columns, shape, sort, cut. One plan for the first page."""
    records = triage.to_records(triage.apply_filter(table, wanted))
    return triage.page(records, page, sort, descending, size)


def list_filings(table: DataFrame, limit: int = triage.DEFAULT_LIMIT) -> DataFrame:
    """The newest records. The limit is taken on stored rows, so only those are shaped."""
    return triage.to_records(triage.newest(table, limit))


def get_filing(table: DataFrame, record_id: str) -> DataFrame:
    """One shaped record, or ``NotFound``."""
    found = triage.to_records(triage.lookup(table, record_id))
    if found.isEmpty():
        raise NotFound(record_id)
    return found


class Warehouse:
    """The stored triage table and audit log under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @property
    def table(self) -> DataFrame:
        return read_gold(self.spark, f"{self.root}/gold")

    def filings(self, limit: int = triage.DEFAULT_LIMIT) -> DataFrame:
        return triage.to_records(standing.newest(self.spark, f"{self.root}/gold", limit))

    def filing(self, record_id: str) -> DataFrame:
        return get_filing(self.table, record_id)

    def view(self, *args, **options) -> DataFrame:
        return triage_view(self.table, *args, **options)

    def stats(self) -> dict[str, int]:
        return standing.summary(self.spark, f"{self.root}/gold").first().asDict()

    def pii_audit(self, limit: int = triage.DEFAULT_LIMIT) -> DataFrame:
        return triage.newest_audit(read_pii_log(self.spark, f"{self.root}/pii_log"), limit)
