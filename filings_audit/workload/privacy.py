"""Masking, audit and detection of personal data."""

from __future__ import annotations

from pyspark.sql import functions as F

from filings_audit.functions.patterns import NAME_HINTS, PII_PATTERNS
from filings_audit.operators import masking
from filings_audit.operators.masking import MaskingConfig
from filings_audit.plans import medallion
from filings_audit.schemas import BRONZE
from filings_audit.session import configure, new_dir
from filings_audit.sinks import audit_log, layers, rotation
from filings_audit.operators.triage import newest_audit
from filings_audit.sources import star_schema
from filings_audit.workload import fixture, oracle
from filings_audit.workload.fixture import as_of
from filings_audit.workload.registry import query

ALL_TYPES = tuple(PII_PATTERNS)
DEFAULT = MaskingConfig()
DOCUMENTS = MaskingConfig(hash_columns=("source",), scan_columns=("text",), types=ALL_TYPES)
TURNS = MaskingConfig(hash_columns=(), scan_columns=("text",))
RUN = "run-1"


def _documents(spark, sf_dir):
    return star_schema.table(spark, sf_dir, "documents").select("doc_id", "source", "text")


@query("pii_redact", f"""
WITH {oracle.staged_redaction('documents', 'doc_id, source', 'text', ALL_TYPES)}
SELECT doc_id, {oracle.sha256('source', DEFAULT.salt)} AS source, t AS text FROM r{len(ALL_TYPES)}""")
def pii_redact(spark, sf_dir):
    return masking.mask_values(_documents(spark, sf_dir), DOCUMENTS)


@query("pii_redact_turns", f"""
WITH {oracle.staged_redaction('conversations', 'conv_id, turn', 'text', TURNS.types)}
SELECT conv_id, turn, t AS text FROM r{len(TURNS.types)}""")
def pii_redact_turns(spark, sf_dir):
    turns = star_schema.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return masking.mask_values(turns, TURNS)


def _hits_sql(k: int, name: str) -> str:
    return f"SELECT doc_id, 'text' AS field_name, '{name}' AS pii_type, 'regex_redact' AS masking_method FROM r5 WHERE h{k}"


_HITS = " UNION ALL ".join(
    ["SELECT doc_id, 'source' AS field_name, 'EXECUTIVE_NAME' AS pii_type, 'sha256' AS masking_method FROM r5 WHERE source IS NOT NULL"]
    + [_hits_sql(k, name) for k, name in enumerate(ALL_TYPES, 1)]
)
_STAGED = oracle.staged_redaction("documents", "doc_id, source", "text", ALL_TYPES)
_AUDIT = f"""
WITH {_STAGED},
hits AS ({_HITS}),
audit AS (
  SELECT field_name, pii_type, masking_method, count(*) AS record_count FROM hits GROUP BY ALL)"""
_ENTRY = f"""{oracle.uuid5(f"'{RUN}:' || field_name || ':' || pii_type")} AS id, '{RUN}' AS source_file_id,
  field_name, pii_type, masking_method, 'live' AS pipeline_mode, record_count"""


@query("pii_audit", f"{_AUDIT} SELECT {_ENTRY} FROM audit")
def pii_audit(spark, sf_dir):
    masked = masking.mask(_documents(spark, sf_dir), DOCUMENTS)
    return masking.audit_entries(masked, RUN, as_of(), "live").drop("detection_ts")


@query("pii_row_hits", f"""
WITH {_STAGED}, hits AS ({_HITS})
SELECT doc_id AS record_id, field_name, pii_type, masking_method FROM hits""")
def pii_row_hits(spark, sf_dir):
    return masking.row_hits(masking.mask(_documents(spark, sf_dir), DOCUMENTS), "doc_id")


def _count_sql(table: str, column: str, name: str) -> str:
    regex = oracle.quote(PII_PATTERNS[name].regex)
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS field_name, '{name}' AS pii_type, "
        f"count(*) FILTER (WHERE regexp_matches({column}, {regex})) AS rows_hit, "
        f"count({column}) AS rows_present FROM {table}"
    )


@query("pii_counts", " UNION ALL ".join(
    f"SELECT field_name, pii_type, rows_hit, rows_present FROM ({_count_sql('documents', 'text', n)})" for n in ALL_TYPES))
def pii_counts(spark, sf_dir):
    return masking.pattern_counts(_documents(spark, sf_dir), ["text"], ALL_TYPES)


# The string columns of the given tables; tables without any have no row.
SCANNED = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"], "documents": ["text", "lang", "source"],
    "pages": ["url", "html"], "benchmark": ["text"], "conversations": ["role", "text"],
}
_HINT = " OR ".join(f"contains(lower(field_name), '{hint}')" for hint in NAME_HINTS)


@query("pii_column_scan", f"""
WITH cells AS ({' UNION ALL '.join(_count_sql(t, c, n) for t, cs in SCANNED.items() for c in cs for n in ALL_TYPES)}),
rated AS (SELECT *, round(CASE WHEN rows_present > 0 THEN rows_hit / rows_present ELSE 0 END, 6) AS hit_rate,
  ({_HINT}) AS name_hint FROM cells)
SELECT * FROM rated WHERE hit_rate > 0 OR name_hint""")
def pii_column_scan(spark, sf_dir):
    found = None
    for name in SCANNED:
        columns = masking.detect_pii_columns(star_schema.table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        found = columns if found is None else found.unionByName(columns)
    return found


@query("remask_salt", f"""
WITH {oracle.FILINGS}
SELECT id, {oracle.sha256('executive_name', 'salt-v2')} AS executive_name, 'sha256-v2' AS masking_version FROM filings""")
def remask_salt(spark, sf_dir):
    raw = star_schema.submissions(spark, sf_dir).select("id", "executive_name")
    return masking.remask(raw, DEFAULT, "salt-v2", "sha256-v2")


@query("rotate_salt", f"""
WITH {oracle.FILINGS}
SELECT id AS filename, strftime(filing_date, '%Y') AS edgar_year, 'QTR' || quarter(filing_date) AS edgar_quarter,
  {oracle.sha256('executive_name', 'salt-v2')} AS executive_name, 'sha256-v2' AS masking_version FROM filings""")
def rotate_salt(spark, sf_dir):
    """M9: a masked table is brought to a new salt; the run stops after one quarter and is taken up again."""
    work = new_dir(configure(spark), "rotation")
    rows = star_schema.submissions(spark, sf_dir).select(
        F.col("id").alias("filename"), "executive_name", F.date_format("filing_date", "yyyy").alias("edgar_year"),
        F.concat(F.lit("QTR"), F.quarter("filing_date").cast("string")).alias("edgar_quarter"))
    layers.write_bronze(rows, f"{work}/bronze")
    raw = spark.read.schema(BRONZE).parquet(f"{work}/bronze").select("filename", "executive_name", *rotation.QUARTERS)
    rotation.rotate(raw, f"{work}/masked", DEFAULT, DEFAULT.salt, "sha256-v1")
    rotation.rotate(raw, f"{work}/masked", DEFAULT, "salt-v2", "sha256-v2", at_most=1)
    rotation.rotate(raw, f"{work}/masked", DEFAULT, "salt-v2", "sha256-v2")
    return rotation.read_masked(spark, f"{work}/masked", raw.schema).select(
        "filename", "edgar_year", "edgar_quarter", "executive_name", "masking_version")


_NOTES = oracle.FILINGS + """,
noted AS (SELECT id, order_key, executive_name, text AS internal_notes FROM filings LEFT JOIN documents ON doc_id = order_key)"""


@query("masked_suffix", f"""
WITH {_NOTES},
{oracle.staged_redaction('noted', 'id, executive_name', 'internal_notes', DEFAULT.types)}
SELECT id AS filing_id, {oracle.sha256('executive_name', DEFAULT.salt)} AS executive_name_masked,
  t AS internal_notes_masked FROM r{len(DEFAULT.types)}""")
def masked_suffix(spark, sf_dir):
    """X9 over raw records with their notes."""
    raw = star_schema.raw_records(spark, sf_dir).select("filing_id", "executive_name", "internal_notes")
    return masking.mask_values(raw, DEFAULT, suffix="_masked")


@query("column_tags", f"""
SELECT 'documents' AS table_name, 'source' AS column_name, 'sha256' AS masking, count(source) AS present, count(source) AS masked FROM documents
UNION ALL SELECT 'documents', 'text', 'regex_redact', count(text), count(*) FILTER (WHERE text <> t)
FROM (WITH {oracle.staged_redaction('documents', 'text', 'text', ALL_TYPES, prefix='d')} SELECT text, t FROM d{len(ALL_TYPES)})
UNION ALL SELECT 'conversations', 'text', 'regex_redact', count(text), count(*) FILTER (WHERE text <> t)
FROM (WITH {oracle.staged_redaction('conversations', 'text', 'text', TURNS.types, prefix='c')} SELECT text, t FROM c{len(TURNS.types)})""")
def column_tags(spark, sf_dir):
    """A stored table tells by itself which of its columns are masked and how; the tags survive the write."""
    out = None
    for name, config in (("documents", DOCUMENTS), ("conversations", TURNS)):
        given = star_schema.table(spark, sf_dir, name)
        path = new_dir(configure(spark), "tagged")
        originals = [F.col(c).alias(f"given_{c}") for c in given.columns]
        masking.mask_values(given.select("*", *originals), config).write.parquet(path)
        stored = spark.read.parquet(path)
        tagged = [(f.name, f.metadata["masking"]) for f in stored.schema.fields if f.metadata.get("pii")]
        counts = [
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(method).alias("masking"),
                     F.count(c).alias("present"), F.count_if(F.col(c) != F.col(f"given_{c}")).alias("masked"))
            for c, method in tagged
        ]
        rows = stored.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("masked_intake", f"""
WITH {oracle.FILINGS}
SELECT id AS filing_id, form_type, company_name, {oracle.sha256('executive_name', DEFAULT.salt)} AS executive_name,
  CAST(revenue_usd AS DOUBLE) AS revenue_usd, 'sha256-v1' AS masking_version, true AS pii_masked FROM filings""")
def masked_intake(spark, sf_dir):
    rows = medallion.mask_intake(star_schema.raw_records(spark, sf_dir), as_of=as_of())
    return rows.select("filing_id", "form_type", "company_name", "executive_name",
                       F.col("revenue_usd").cast("double").alias("revenue_usd"), "masking_version", "pii_masked")


# Messages that quote a contact, so that the re-scan has something to find.
_CONTACT = "root_cause_message || ' Contact filer' || cik || '@example.org or 212-555-0147.'"


@query("post_rca_scan", f"""
WITH {oracle.GOLD},
said AS (SELECT id, {_CONTACT} AS message FROM gold),
{oracle.staged_redaction('said', 'id', 'message', DEFAULT.types)}
SELECT id, t AS root_cause_message, coalesce(h2, false) AS email_hit, coalesce(h3, false) AS phone_hit
FROM r{len(DEFAULT.types)}""")
def post_rca_scan(spark, sf_dir):
    rows = fixture.triage_rows(spark, sf_dir)
    quoted = F.concat("root_cause_message", F.lit(" Contact filer"), "cik", F.lit("@example.org or 212-555-0147."))
    masked = masking.mask_messages(rows.select("id", quoted.alias("root_cause_message")), DEFAULT)
    found = F.transform(masking.HITS, lambda hit: hit["pii_type"])
    return masked.select("id", "root_cause_message", F.array_contains(found, "EMAIL").alias("email_hit"),
                         F.array_contains(found, "PHONE").alias("phone_hit"))


def _type_rows(stage: str, source: str, field: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source_file_id, '{field}' AS field_name, '{name}' AS pii_type FROM {stage} WHERE h{k}"
        for k, name in enumerate(DEFAULT.types, 1)
    )


@query("audit_union", f"""
WITH {_NOTES},
{oracle.staged_redaction('noted', 'id, executive_name', 'internal_notes', DEFAULT.types)},
{oracle.staged_redaction('conversations', 'conv_id', 'text', DEFAULT.types, 'q')},
hits AS (
  SELECT '{RUN}' AS source_file_id, 'executive_name' AS field_name, 'EXECUTIVE_NAME' AS pii_type
  FROM noted WHERE executive_name IS NOT NULL
  UNION ALL {_type_rows('r4', RUN, 'internal_notes')}
  UNION ALL {_type_rows('q4', masking.post_rca(RUN), 'root_cause_message')})
SELECT source_file_id, field_name, pii_type, count(*) AS record_count FROM hits GROUP BY ALL""")
def audit_union(spark, sf_dir):
    """The audits of two masking passes, the second over texts written later."""
    first = masking.mask(star_schema.raw_records(spark, sf_dir), DEFAULT)
    later = star_schema.table(spark, sf_dir, "conversations").select(F.col("text").alias("root_cause_message"))
    second = masking.mask_messages(later, DEFAULT)
    entries = masking.audit_entries(first, RUN, as_of()).unionByName(
        masking.audit_entries(second, masking.post_rca(RUN), as_of()))
    return entries.select("source_file_id", "field_name", "pii_type", "record_count")


@query("audit_newest", f"{_AUDIT} SELECT {_ENTRY} FROM audit ORDER BY id LIMIT 200")
def audit_newest(spark, sf_dir):
    """Written twice, stored once, read newest first."""
    path = new_dir(configure(spark), "pii-log")
    entries = masking.audit_entries(masking.mask(_documents(spark, sf_dir), DOCUMENTS), RUN, as_of(), "live")
    audit_log.write_pii_log(entries, path)
    audit_log.write_pii_log(entries, path)
    return newest_audit(audit_log.read_pii_log(spark, path)).drop("detection_ts")


@query("event_log_filter", """
SELECT CAST(event_id AS VARCHAR) AS log_id, CAST(user_id AS VARCHAR) AS filing_id, 'MASK' AS event_type,
  CAST(CAST(value * 1e4 AS DECIMAL(20,2)) AS DOUBLE) AS revenue_usd, 'run-' || strftime(ts, '%Y%m%d') AS pipeline_run_id
FROM events WHERE event_type = 'click' AND user_id % 5 = 2
  AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""")
def event_log_filter(spark, sf_dir):
    """Append the log, then query it by type, form and time."""
    from datetime import datetime

    path = new_dir(configure(spark), "event-log")
    audit_log.initialise(spark, path)
    audit_log.initialise(spark, path)
    audit_log.append_events(star_schema.event_log(spark, sf_dir), path)
    log = spark.read.schema(audit_log.EVENT_LOG).parquet(path)
    wanted = audit_log.EventFilter("MASK", "10-K", datetime(2024, 1, 5), datetime(2024, 1, 20, 12))
    return audit_log.query_events(log, wanted).select(
        "log_id", "filing_id", "event_type", F.col("revenue_usd").cast("double").alias("revenue_usd"), "pipeline_run_id")
