import re

import pytest
from pyspark.sql import functions as F

from filings_audit.functions.patterns import PII_PATTERNS, PiiPattern, placeholder
from filings_audit.operators import masking
from filings_audit.operators.masking import MaskingConfig
from filings_audit.sources import star_schema

AS_OF = "2024-01-01 00:00:00"
GOLDEN = [
    ("Write to dana.quill@example.org before Friday.", "Write to [REDACTED_EMAIL] before Friday."),
    ("Tax number 219-09-9999 appears in exhibit 4.", "Tax number [REDACTED_SSN] appears in exhibit 4."),
    ("Call 212-555-0147 or (646) 555-0199.", "Call [REDACTED_PHONE] or ([REDACTED_PHONE]."),
    ("Card 4111 1111 1111 1111, mail ops@example.net", "Card [REDACTED_CREDIT_CARD], mail [REDACTED_EMAIL]"),
    ("+1 555.123.4567", "+[REDACTED_PHONE]"),
    ("378282246310005 and 10.0.0.1", "378282246310005 and 10.0.0.1"),
    ("Nothing here.", "Nothing here."),
    (None, None),
]
CONFIG = MaskingConfig(hash_columns=("executive_name",), scan_columns=("note", "absent"))


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


@pytest.fixture(scope="module")
def notes(spark):
    rows = [(i, f"Exec {i}" if i % 2 else None, text) for i, (text, _) in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "id int, executive_name string, note string")


def _by_python(text, types):
    hits = []
    for name in PII_PATTERNS:
        if name in types and text is not None:
            changed, n = re.subn(PII_PATTERNS[name].regex, placeholder(name), text)
            hits += [name] if n else []
            text = changed
    return text, hits


def test_golden_texts(notes):
    found = {r.id: r.note for r in masking.mask_values(notes, CONFIG).collect()}
    assert [found[i] for i in range(len(GOLDEN))] == [expected for _, expected in GOLDEN]


def test_audit_counts(notes):
    entries = masking.audit_entries(masking.mask(notes, CONFIG), "run-1", _as_of(), "live").collect()
    counts = {(e.field_name, e.pii_type, e.masking_method): e.record_count for e in entries}
    assert counts == {
        ("executive_name", "EXECUTIVE_NAME", "sha256"): 4,
        ("note", "SSN", "regex_redact"): 1,
        ("note", "EMAIL", "regex_redact"): 2,
        ("note", "PHONE", "regex_redact"): 2,
        ("note", "CREDIT_CARD", "regex_redact"): 1,
    }
    assert {e.source_file_id for e in entries} == {"run-1"} and {e.pipeline_mode for e in entries} == {"live"}
    assert len({e.id for e in entries}) == len(entries)


def test_matches_python_on_real_texts(spark, sf_dir):
    """Every document and turn, whole, against Python's own engine."""
    types = tuple(PII_PATTERNS)
    config = MaskingConfig(hash_columns=(), scan_columns=("text",), types=types)
    for table in ("documents", "conversations", "benchmark"):
        source = star_schema.table(spark, sf_dir, table).select("text").distinct()
        masked = masking.mask(source.withColumn("before", F.col("text")), config).collect()
        for row in masked:
            text, hits = _by_python(row.before, types)
            assert row.text == text
            assert [hit.pii_type for hit in row.pii_hits] == hits


def test_unicode_digits_and_borders(spark):
    texts = ["é212-555-0147", "２１２-555-0147", "x@exämple.org", "٣٤٥-٦٧-٨٩٠١", "a1@b.co|4111-1111-1111-1111"]
    types = tuple(PII_PATTERNS)
    frame = spark.createDataFrame([(t, t) for t in texts], "before string, text string")
    config = MaskingConfig(hash_columns=(), scan_columns=("text",), types=types)
    for row in masking.mask_values(frame, config).collect():
        assert row.text == _by_python(row.before, types)[0]


def test_second_application_changes_nothing(notes):
    config = MaskingConfig(hash_columns=(), scan_columns=("note",), types=tuple(PII_PATTERNS))
    once = masking.mask_values(notes, config)
    twice = masking.mask(once, config)
    assert once.select("note").exceptAll(twice.select("note")).count() == 0
    assert masking.audit_entries(twice, "again", _as_of()).count() == 0


def test_no_raw_value_survives(notes):
    masked = masking.mask(notes, CONFIG)
    entries = masking.audit_entries(masked, "run-1", _as_of())
    dump = str(masked.collect()) + str(entries.collect()) + str(masking.row_hits(masked, "id").collect())
    for secret in ("dana.quill", "219-09-9999", "555-0147", "4111", "Exec 1"):
        assert secret not in dump


def test_row_hits_agree_with_the_audit(notes):
    masked = masking.mask(notes, CONFIG)
    per_row = masking.row_hits(masked, "id").groupBy("field_name", "pii_type").count().collect()
    audit = masking.audit_entries(masked, "r", _as_of()).collect()
    assert {(r[0], r[1], r[2]) for r in per_row} == {(e.field_name, e.pii_type, e.record_count) for e in audit}


def test_all_null_and_absent_columns_leave_no_entry(spark):
    frame = spark.createDataFrame([(None, None)], "executive_name string, note string")
    masked = masking.mask(frame, CONFIG)
    assert masking.audit_entries(masked, "r", _as_of()).count() == 0
    assert masked.columns == ["executive_name", "note", "pii_hits"]


def test_suffix_and_metadata(notes):
    masked = masking.mask_values(notes, CONFIG, suffix="_masked")
    assert masked.columns == ["id", "executive_name_masked", "note_masked"]
    assert masked.schema["executive_name_masked"].metadata == {"pii": True, "masking": "sha256"}
    assert masked.schema["note_masked"].metadata["masking"] == "regex_redact"


def test_registry_can_grow(spark):
    registry = {**PII_PATTERNS, "TICKET": PiiPattern(r"T-\d+")}
    config = MaskingConfig(hash_columns=(), scan_columns=("t",), types=("TICKET",), registry=registry)
    frame = spark.createDataFrame([("see T-12 and T-7",)], "t string")
    assert masking.mask_values(frame, config).first().t == "see [REDACTED_TICKET] and [REDACTED_TICKET]"


def test_rotated_salt_changes_hashes_and_same_salt_does_not(notes):
    one = masking.mask_values(notes, CONFIG)
    again = masking.mask_values(notes, CONFIG)
    rotated = masking.remask(notes, CONFIG, "salt-v2", "sha256-v2")
    key = lambda df: {r.id: r.executive_name for r in df.collect()}
    assert key(one) == key(again)
    assert all(v is None or v != key(one)[k] for k, v in key(rotated).items())


def test_counts_and_column_scan(notes):
    counts = {(r.field_name, r.pii_type): (r.rows_hit, r.rows_present)
              for r in masking.pattern_counts(notes, ["note"], tuple(PII_PATTERNS)).collect()}
    assert counts[("note", "EMAIL")] == (2, 7)
    assert counts[("note", "IP_ADDRESS")] == (1, 7)
    found = {(r.field_name, r.pii_type) for r in masking.detect_pii_columns(notes).collect()}
    assert ("executive_name", "SSN") in found and ("note", "PHONE") in found


def test_masking_stays_in_the_jvm_and_matches_each_type_once(notes):
    plan = masking.audit_entries(masking.mask(notes, CONFIG), "r", _as_of())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for pii_type in CONFIG.types:
        assert plan.count(placeholder(pii_type)) == 1
