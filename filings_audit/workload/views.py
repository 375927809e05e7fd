"""Shaping and reading the stored triage table."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.functions import scores, shaping
from filings_audit.operators import keyed, search, triage
from filings_audit.operators.triage import TriageFilter
from filings_audit.plans import reads, standing
from filings_audit.session import configure, new_dir
from filings_audit.sinks import layers
from filings_audit.sources import star_schema
from filings_audit.workload import oracle
from filings_audit.workload.fixture import published, published_root
from filings_audit.workload.intake import _UUID
from filings_audit.workload.registry import query


def _flags():
    return F.col("known_rule_violation"), F.col("ml_anomaly_flag")


@query("risk_cluster", f"WITH {oracle.triage()} SELECT id, {oracle.CLUSTER} AS risk_cluster FROM triage")
def risk_cluster(spark, sf_dir):
    return published(spark, sf_dir).select("id", scores.risk_cluster(F.col("ml_anomaly_score")).alias("risk_cluster"))


@query("score_interval", f"""
WITH {oracle.triage()}
SELECT id, CAST({oracle.LOW} AS DOUBLE) AS low, CAST({oracle.HIGH} AS DOUBLE) AS high,
  CAST({oracle.LOW} AS VARCHAR) || ' – ' || CAST({oracle.HIGH} AS VARCHAR) AS interval_text FROM triage""")
def score_interval(spark, sf_dir):
    low, high, text = scores.score_interval(F.col("ml_anomaly_score"))
    return published(spark, sf_dir).select(
        "id", low.cast("double").alias("low"), high.cast("double").alias("high"), text.alias("interval_text"))


@query("issue_status", f"""
WITH {oracle.triage()}
SELECT id, {oracle.by_flag("Rule Violation", "ML Anomaly", "None")} AS issue_type, {oracle.SEVERITY} AS severity,
  {oracle.by_flag("Needs Review", "In Progress", "Resolved")} AS status, {oracle.NEEDS} AS needs_triage FROM triage""")
def issue_status(spark, sf_dir):
    return published(spark, sf_dir).select(
        "id", shaping.issue_type(*_flags()).alias("issue_type"), shaping.severity(*_flags()).alias("severity"),
        shaping.review_status(*_flags()).alias("status"), shaping.needs_triage(*_flags()).alias("needs_triage"))


@query("workflow_status", f"""
WITH {oracle.triage()} SELECT id, CASE WHEN {oracle.NEEDS} THEN 'Pending' ELSE 'Resolved' END AS status FROM triage""")
def workflow_status(spark, sf_dir):
    return published(spark, sf_dir).select("id", shaping.workflow_status(*_flags()).alias("status"))


@query("assignee_route", f"""
WITH {oracle.FILINGS},
ids AS (SELECT id FROM filings UNION ALL SELECT {_UUID} FROM filings)
SELECT id, {oracle.ASSIGNEE} AS assignee FROM ids""")
def assignee_route(spark, sf_dir):
    """F11 for numeric ids and for UUIDs."""
    from filings_audit.functions.identity import filing_uuid
    from filings_audit.operators.cleaning import strip_cik

    rows = star_schema.submissions(spark, sf_dir)
    uuids = filing_uuid(strip_cik(F.col("cik")), F.col("filing_date"), F.col("form_type"))
    ids = rows.select(F.explode(F.array(F.col("id"), uuids)).alias("id"))
    return ids.select("id", shaping.assignee(F.col("id")).alias("assignee"))


@query("alert_age", f"""
WITH {oracle.triage()}, aged AS (SELECT id, {oracle.AGE_HOURS} AS hours FROM triage)
SELECT id, hours, CASE WHEN hours < 24 THEN hours || 'h' ELSE (hours // 24) || 'd' END AS alert_age FROM aged""")
def alert_age(spark, sf_dir):
    rows = published(spark, sf_dir).select("id", shaping.alert_age_hours(F.col("id"), F.col("ml_anomaly_score")).alias("hours"))
    return rows.withColumn("alert_age", shaping.age_token(F.col("hours")))


@query("revenue_text", f"""
WITH {oracle.FILINGS}
SELECT id, {oracle.REVENUE} AS revenue, {oracle.RATIO} AS cash_ratio FROM filings""")
def revenue_text(spark, sf_dir):
    cash = F.col("operating_cash_flow")
    return star_schema.filings(spark, sf_dir, growth=False).select(
        "id", shaping.billions_text(cash).alias("revenue"), shaping.cash_ratio(cash).alias("cash_ratio"))


@query("display_texts", f"""
WITH {oracle.FILINGS}
SELECT id, strftime(filing_date, '%Y-%m-%d') AS filed,
  {oracle.text_number("CAST(revenue_growth AS DECIMAL(28,10)) * 100", 1)} || '%' AS growth,
  CASE WHEN operating_cash_flow < 0 THEN '-$' ELSE '$' END || format('{{:,.2f}}', CAST(abs(operating_cash_flow) AS DOUBLE)) AS cash_flow,
  coalesce(nullif(executive_name, ''), 'N/A') AS executive FROM filings""")
def display_texts(spark, sf_dir):
    """F15, F16, X4."""
    return star_schema.filings(spark, sf_dir).select(
        "id", shaping.date_text(F.col("filing_date")).alias("filed"),
        shaping.percent_text(F.col("revenue_growth")).alias("growth"),
        shaping.dollars_text(F.col("operating_cash_flow")).alias("cash_flow"),
        shaping.or_not_available(F.col("executive_name")).alias("executive"))


_CONTRIB = f"{oracle.GROWTH3} AS growth_delta, {oracle.RATIO} AS cash_ratio, {oracle.SHARE} AS frequency"


@query("feature_contrib", f"WITH {oracle.triage()} SELECT id, {_CONTRIB} FROM triage")
def feature_contrib(spark, sf_dir):
    parts = shaping.feature_contributions(F.col("revenue_growth"), F.col("operating_cash_flow"), F.col("ml_anomaly_score"))
    return published(spark, sf_dir).select("id", parts.alias("c")).select(
        "id", F.col("c.revenueGrowthDelta").alias("growth_delta"), F.col("c.cashFlowRatio").alias("cash_ratio"),
        F.col("c.filingFrequency").alias("frequency"))


@query("top_feature", f"""
WITH {oracle.triage()}, parts AS (SELECT id, {_CONTRIB} FROM triage)
SELECT id, CASE greatest(abs(growth_delta), abs(cash_ratio), abs(frequency)) WHEN abs(growth_delta) THEN 'revenueGrowthDelta'
  WHEN abs(cash_ratio) THEN 'cashFlowRatio' ELSE 'filingFrequency' END AS top_feature FROM parts""")
def top_feature(spark, sf_dir):
    parts = shaping.feature_contributions(F.col("revenue_growth"), F.col("operating_cash_flow"), F.col("ml_anomaly_score"))
    return published(spark, sf_dir).select("id", shaping.top_feature(parts).alias("top_feature"))


def _records(spark, sf_dir):
    return triage.to_records(published(spark, sf_dir))


def _flat(records):
    return records.select(
        "id", "company", F.col("filingDate").alias("filing_date"), F.col("issueType").alias("issue_type"), "severity",
        "cik", F.col("formType").alias("form_type"), "revenue", F.col("knownRuleViolation").alias("rule"),
        F.col("mlAnomalyFlag").alias("ml"), F.col("needsTriage").alias("needs_triage"), "status", "assignee",
        F.col("alertAge").alias("alert_age"), F.col("violationDetails").alias("details"),
        F.col("mlTelemetry.anomalyScore").alias("score"), F.col("mlTelemetry.isolationCluster").alias("cluster"),
        F.col("mlTelemetry.ingestionTs").alias("ingestion_ts"), F.col("mlTelemetry.modelVersion").alias("model_version"),
        F.col("mlTelemetry.featureContrib.revenueGrowthDelta").alias("growth_delta"),
        F.col("mlTelemetry.featureContrib.cashFlowRatio").alias("cash_ratio"),
        F.col("mlTelemetry.featureContrib.filingFrequency").alias("frequency"),
        F.col("mlTelemetry.confidenceInterval").alias("interval_text"))


@query("triage_record", f"WITH {oracle.RECORDS} SELECT * EXCLUDE (created_at) FROM records")
def triage_record(spark, sf_dir):
    """F22, flattened."""
    return _flat(_records(spark, sf_dir))


@query("intake_record", f"""
WITH {oracle.GOLD}
SELECT id, company_name AS company, {oracle.by_flag("Rule Violation", "ML Anomaly", "None")} AS issue_type,
  '$' || CAST(round(revenue_usd * CAST(0.000000001 AS DECIMAL(10,9)), 1) AS DECIMAL(30,1)) || 'B' AS revenue,
  0.0::DOUBLE AS growth_delta FROM gold""")
def intake_record(spark, sf_dir):
    """intake rows shaped like stored ones."""
    from filings_audit.workload.fixture import triage_rows

    rows = triage.to_records(triage.adapt_intake(triage_rows(spark, sf_dir), F.col("order_key")))
    return _flat(rows).select("id", "company", "issue_type", "revenue", "growth_delta")


@query("urgent_alerts", f"""
WITH {oracle.RECORDS} SELECT id, alert_age FROM records WHERE {oracle.TOKEN_HOURS} >= 48""")
def urgent_alerts(spark, sf_dir):
    # Only rows in triage have an age; the cheap flag test spares the others the hashing.
    queue = triage.apply_filter(published(spark, sf_dir), TriageFilter(needs_review=True))
    rows = triage.to_records(queue).select("id", F.col("alertAge").alias("alert_age"))
    return rows.filter(shaping.is_urgent(F.col("alert_age")))


# Counts -------------------------------------------------------------------------------------------

_COUNTS = """count(*) AS total, count(*) FILTER (WHERE known_rule_violation) AS violations,
  count(*) FILTER (WHERE ml_anomaly_flag) AS anomalies,
  count(*) FILTER (WHERE NOT known_rule_violation AND NOT ml_anomaly_flag) AS healthy"""


@query("summary_stats", f"WITH {oracle.triage()} SELECT {_COUNTS} FROM triage")
def summary_stats(spark, sf_dir):
    return standing.summary(spark, published_root(spark, sf_dir))


@query("summary_avg_score", f"""
WITH {oracle.triage()}
SELECT {_COUNTS},
  round(CAST(sum(CAST(ml_anomaly_score AS DECIMAL(10,4))) AS DOUBLE) / count(ml_anomaly_score), 6) AS average_score FROM triage""")
def summary_avg_score(spark, sf_dir):
    return standing.summary(spark, published_root(spark, sf_dir), with_average=True)


# Filters ------------------------------------------------------------------------------------------

def _filter_query(name: str, wanted: TriageFilter, condition: str):
    sql = (
        f"WITH {oracle.triage()} SELECT id, company_name, strftime(filing_date, '%Y-%m-%d') AS filing_date "
        f"FROM triage WHERE {condition}"
    )

    @query(name, sql)
    def run(spark, sf_dir):
        rows = triage.apply_filter(published(spark, sf_dir), wanted)
        return rows.select("id", "company_name", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))


SEARCHES = ["Customer#00000001", "0#", "%", "_", "9", "#00000012", "no such name", "r#000000"]


@query("search_index", f"WITH {oracle.triage()}, searches AS (SELECT unnest({SEARCHES!r}) AS wanted) "
       "SELECT wanted, id, company_name FROM triage, searches WHERE contains(lower(company_name), lower(wanted))")
def search_index(spark, sf_dir):
    """P13 by the inverted table: long and short texts, literal wildcards, texts that no name holds."""
    table = published(spark, sf_dir)
    path = new_dir(spark, "search")
    search.write_index(table, path)
    found = [search.search(table, path, text).select(F.lit(text).alias("wanted"), "id", "company_name") for text in SEARCHES]
    return reduce(DataFrame.unionByName, found)


_SPAN = (date(1997, 3, 15), date(1998, 6, 30))
_IN_SPAN = "filing_date BETWEEN DATE '1997-03-15' AND DATE '1998-06-30'"
_filter_query("search_company", TriageFilter(search="CUSTOMER#00000001"), "contains(lower(company_name), 'customer#00000001')")
_filter_query("severity_violation", TriageFilter(severity="violation"), "known_rule_violation")
_filter_query("severity_anomaly", TriageFilter(severity="anomaly"), "ml_anomaly_flag AND NOT known_rule_violation")
_filter_query("needs_review", TriageFilter(needs_review=True), oracle.NEEDS)
_filter_query("flag_filters", TriageFilter(rule=False, ml=True), "ml_anomaly_flag AND NOT known_rule_violation")
_filter_query("date_range", TriageFilter(date_from=_SPAN[0], date_to=_SPAN[1]), _IN_SPAN)
COMBO = TriageFilter("customer#0000000", "violation", True, *_SPAN)
_COMBO = f"contains(lower(company_name), 'customer#0000000') AND known_rule_violation AND {_IN_SPAN}"
_filter_query("filter_combo", COMBO, _COMBO)


@query("filtered_count", f"WITH {oracle.triage()} SELECT count(*) AS matching FROM triage WHERE {_COMBO}")
def filtered_count(spark, sf_dir):
    return triage.matching_count(published(spark, sf_dir), COMBO)


@query("lookup_id", f"WITH {oracle.GOLD} SELECT id, company_name, cik, form_type, root_cause_message FROM gold WHERE id = '1000'")
def lookup_id(spark, sf_dir):
    return triage.lookup(published(spark, sf_dir), "1000").select("id", "company_name", "cik", "form_type", "root_cause_message")


@query("resolved_removed", f"""
WITH {oracle.triage()} SELECT id, company_name FROM triage WHERE {oracle.NEEDS} AND filing_state <> 'F'""")
def resolved_removed(spark, sf_dir):
    """The queue without what has been resolved."""
    queue = triage.apply_filter(published(spark, sf_dir), TriageFilter(needs_review=True)).select("id", "company_name")
    resolved = star_schema.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("id"))
    return keyed.without_ids(queue, resolved)


# Order, top and pages -----------------------------------------------------------------------------

@query("newest_triage", f"""
WITH {oracle.GOLD} SELECT id, company_name, root_cause_message, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM gold ORDER BY created_at DESC, id LIMIT 200""")
def newest_triage(spark, sf_dir):
    rows = standing.newest(spark, published_root(spark, sf_dir))
    return rows.select("id", "company_name", "root_cause_message", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def _placed(rows, order):
    """Number the rows of one page."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


_VIEW = ["id", "company", "formType", "filingDate", "severity", "status", "violationDetails", "assignee", "alertAge", "mlTelemetry", "created_at"]


def _sorted_page(spark, sf_dir, key, descending, number=1, size=10):
    records = _records(spark, sf_dir).select(*_VIEW)
    rows = triage.page(records, number, key, descending, size)
    order = triage.sort_order(key, descending)
    return _placed(rows, order).select("id", "company", "place", F.lit("desc" if descending else "asc").alias("direction"))


def _sort_sql(key: str) -> str:
    one = """(SELECT id, company, row_number() OVER (ORDER BY {key} {way}, created_at DESC, id) AS place,
      '{tag}' AS direction FROM records ORDER BY {key} {way}, created_at DESC, id LIMIT 1000)"""
    ways = [one.format(key=oracle.SORT_SQL[key], way=way, tag=way.lower()) for way in ("ASC", "DESC")]
    return f"WITH {oracle.RECORDS} SELECT * FROM {ways[0]} UNION ALL SELECT * FROM {ways[1]}"


_SORT_NAMES = {
    "company": "sort_company", "formType": "sort_form_type", "filingDate": "sort_filing_date",
    "issueType": "sort_issue_type", "status": "sort_status", "anomalyScore": "sort_score",
    "rootCause": "sort_root_cause", "assignee": "sort_assignee", "alertAge": "sort_age",
}


def _sort_query(key: str, name: str):
    @query(name, _sort_sql(key))
    def run(spark, sf_dir):
        """A long first page in both directions."""
        return _sorted_page(spark, sf_dir, key, False, size=1000).unionByName(_sorted_page(spark, sf_dir, key, True, size=1000))


for _key, _name in _SORT_NAMES.items():
    _sort_query(_key, _name)


@query("page_rows", f"""
WITH {oracle.RECORDS},
ranked AS (SELECT id, company, row_number() OVER (ORDER BY score DESC, created_at DESC, id) AS place FROM records),
total AS (SELECT count(*) AS n FROM records)
SELECT id, company, CAST(place - 20 AS INTEGER) AS place, 'third' AS page FROM ranked WHERE place BETWEEN 21 AND 30
UNION ALL
SELECT id, company, CAST(place - n // 20 * 10 AS INTEGER), 'middle' FROM ranked, total WHERE place > n // 20 * 10 AND place <= n // 20 * 10 + 10
UNION ALL
SELECT id, company, CAST(place - ((n - 1) // 10) * 10 AS INTEGER), 'last' FROM ranked, total WHERE place > ((n - 1) // 10) * 10""")
def page_rows(spark, sf_dir):
    """T5: an early page, the one in the middle of all, and a page beyond the end, which becomes the last."""
    half = published(spark, sf_dir).count() // 20 + 1
    middle = _sorted_page(spark, sf_dir, "anomalyScore", True, half).withColumn("page", F.lit("middle"))
    third = _sorted_page(spark, sf_dir, "anomalyScore", True, 3).withColumn("page", F.lit("third"))
    last = _sorted_page(spark, sf_dir, "anomalyScore", True, 10**9).withColumn("page", F.lit("last"))
    return third.unionByName(middle).unionByName(last).select("id", "company", "place", "page")


@query("sort_collated", f"""
WITH {oracle.RECORDS}, mixed AS (
  SELECT id, created_at, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN upper(company) ELSE lower(company) END AS company FROM records)
SELECT id, company, row_number() OVER (ORDER BY lower(company), company <> lower(company), created_at DESC, id) AS place
FROM mixed ORDER BY place LIMIT 1000""")
def sort_collated(spark, sf_dir):
    """Names in upper and lower case in locale order: letters first, and of equal letters the lower case."""
    even = F.col("id").cast("long") % 2 == 0
    records = _records(spark, sf_dir).select(*_VIEW).withColumn("company", F.when(even, F.upper("company")).otherwise(F.lower("company")))
    rows = triage.page(records, 1, "company", size=1000, collation="UNICODE")
    return _placed(rows, triage.sort_order("company", collation="UNICODE")).select("id", "company", "place")


@query("list_filings", f"""
WITH {oracle.RECORDS} SELECT * EXCLUDE (created_at) FROM records ORDER BY created_at DESC, id LIMIT 200""")
def list_filings(spark, sf_dir):
    """The newest records, shaped."""
    return _flat(reads.list_filings(published(spark, sf_dir)))


@query("triage_view", f"""
WITH {oracle.RECORDS}
SELECT * EXCLUDE (created_at) FROM records
WHERE needs_triage AND filing_date BETWEEN '1997-03-15' AND '1998-06-30' ORDER BY score DESC, records.created_at DESC, id LIMIT 10""")
def triage_view(spark, sf_dir):
    """Filter, shape, sort and cut in one plan."""
    wanted = TriageFilter(needs_review=True, date_from=_SPAN[0], date_to=_SPAN[1])
    return _flat(reads.triage_view(published(spark, sf_dir), wanted, "anomalyScore", True))


# Exports ------------------------------------------------------------------------------------------

@query("export_csv", f"""
WITH {oracle.GOLD} SELECT format, id, company_name, root_cause_message FROM gold, (VALUES ('csv'), ('json'), ('parquet')) f(format)
WHERE known_rule_violation""")
def export_csv(spark, sf_dir):
    """Filtered rows out to each format and back."""
    rows = triage.apply_filter(published(spark, sf_dir), TriageFilter(severity="violation"))
    schema = "id string, company_name string, root_cause_message string"
    found = []
    for fmt in ("csv", "json", "parquet"):
        path = new_dir(configure(spark), "export")
        layers.export(rows.select("id", "company_name", "root_cause_message"), path, fmt)
        options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
        found.append(spark.read.schema(schema).options(**options).format(fmt).load(path).withColumn("format", F.lit(fmt)))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("silver_table", f"""
WITH {oracle.GOLD} SELECT id, cik, form_type, ml_anomaly_flag, ml_anomaly_score FROM gold""")
def silver_table(spark, sf_dir):
    """K2."""
    from filings_audit.schemas import SILVER
    from filings_audit.sources.tables import read_typed
    from filings_audit.workload.fixture import triage_rows

    path = new_dir(configure(spark), "silver")
    layers.write_silver(triage_rows(spark, sf_dir), path)
    return read_typed(spark, path, SILVER).select("id", "cik", "form_type", "ml_anomaly_flag", "ml_anomaly_score")
