"""Whole runs: batch, streams, and the registered queries against SQL."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check_oracle
from filings_audit.functions.identity import filing_uuid
from filings_audit.operators import forest, masking
from filings_audit.operators.forest import ForestParams
from filings_audit.operators.masking import MaskingConfig
from filings_audit.plans import medallion
from filings_audit.schemas import RAW, TRIAGE, conform
from filings_audit.session import new_dir
from filings_audit.sinks import audit_log, gold
from filings_audit.streaming import jobs

AT = datetime(2024, 6, 1)


def _as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _write_index(folder, quarter, companies):
    lines = ["Company Name".ljust(62) + "Form Type".ljust(12) + "CIK".ljust(12) + "Date Filed".ljust(12) + "File Name", "-" * 120]
    for i, (name, form, cik, day) in enumerate(companies):
        lines.append(name.ljust(62) + form.ljust(12) + str(cik).zfill(10).ljust(12) + day.ljust(12) + f"edgar/{cik}/{i}.txt")
    target = folder / "full-index" / "2024" / quarter
    target.mkdir(parents=True, exist_ok=True)
    (target / "company.gz").write_bytes(gzip.compress("\n".join(lines).encode("latin-1")))


def _companies(count, month):
    forms = ["10-K", "10-Q", "8-K", "4"]
    return [(f"Company {i}", forms[i % 4], i + 1, f"2024-{month:02d}-{1 + i % 28:02d}") for i in range(count)]


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(str(i + 1), float(i % 50) * 1e6, 0.05 + (i % 7) / 100, 1e9 + i * 1e6, f"Exec {i}" if i % 4 else None) for i in range(200)]
    rows[12] = ("13", 1e6, 0.9, -5e10, "Dana Quill")
    frame = spark.createDataFrame(rows, "cik string, revenue_usd double, revenue_growth double, operating_cash_flow double, executive_name string")
    return frame.withColumns({c: F.col(c).cast("decimal(20,2)") for c in ("revenue_usd", "operating_cash_flow")})


def test_batch_run_end_to_end(spark, tmp_path, facts):
    companies = _companies(200, 2)
    _write_index(tmp_path, "QTR1", [*companies, companies[12]])  # one filing listed twice
    config = medallion.LiveConfig(root=new_dir(spark, "run"), run_id="run-1", forest=ForestParams(trees=30, sample_size=64))
    index = str(tmp_path / "full-index/*/*/company.gz")
    result = medallion.run_batch(spark, index, facts, config, _as_of())
    rows = {r.cik: r for r in result.gold.collect()}
    assert len(rows) == 150 and result.silver.count() == 150
    outlier = rows["13"]
    assert outlier.known_rule_violation and outlier.ml_anomaly_flag and outlier.root_cause_message
    assert outlier.created_at == AT
    expected = spark.range(1).select(filing_uuid(F.lit("13"), F.lit(outlier.filing_date), F.lit("10-K"))).first()[0]
    assert outlier.id == expected
    assert sum(r.ml_anomaly_flag for r in rows.values()) == pytest.approx(0.08 * 150, abs=2)
    entries = {(e.source_file_id, e.field_name): e.record_count for e in result.pii_log.collect()}
    named = sum(1 for i in range(200) if i % 4 != 3 and (i % 4 or i == 12))
    assert entries == {("run-1", "executive_name"): named}
    assert all(r.executive_name is None or len(r.executive_name) == 64 for r in result.silver.collect())
    # The same run again changes nothing, and a second quarter only adds.
    again = medallion.run_batch(spark, index, facts, config, _as_of())
    assert again.gold.exceptAll(result.gold).count() == 0 and again.gold.count() == 150
    assert again.pii_log.count() == 1
    _write_index(tmp_path, "QTR2", _companies(40, 5))
    second = str(tmp_path / "full-index/2024/QTR2/company.gz")
    more = medallion.run_batch(spark, second, facts, medallion.LiveConfig(root=config.root, run_id="run-2", forest=config.forest), _as_of())
    assert more.gold.count() > 150
    # The second run scores, logs and rewrites its own quarter only.
    found = {(e.source_file_id, e.field_name): e.record_count for e in more.pii_log.collect()}
    assert found[("run-1", "executive_name")] == named and found[("run-2", "executive_name")] < 40
    later = {r.cik: r for r in more.gold.filter("filing_month < '2024-04'").collect()}
    assert later == {cik: r for cik, r in rows.items() if r.filing_month < "2024-04"}


def test_intake_load_twice_is_once(spark):
    day = datetime(2024, 1, 1).date()
    rows = [(f"f{i}", "10-K", day, "Quill", "7", "Dana Quill" if i else None, "CFO", None, "mail a@b.org", "<x/>", "s@t.org") for i in range(3)]
    raw = spark.createDataFrame(rows, RAW)
    root = new_dir(spark, "intake")
    for _ in range(2):
        medallion.load_intake(raw, root, "run-1", _as_of())
    assert gold.read_gold(spark, root + "/gold").count() == 3
    log = {(e.field_name, e.pii_type): e.record_count for e in audit_log.read_pii_log(spark, root + "/pii_log").collect()}
    assert log == {("executive_name", "EXECUTIVE_NAME"): 2, ("internal_notes", "EMAIL"): 3}
    slim = medallion.mask_intake(raw, as_of=_as_of())
    assert "internal_notes" not in slim.columns and slim.first().masking_version == "sha256-v1"


# Streams --------------------------------------------------------------------------------------------

def test_index_stream_equals_batch_and_picks_up_new_files(spark, tmp_path):
    from filings_audit.sources.index_files import read_index

    work = new_dir(spark, "s")
    glob = str(tmp_path / "full-index/*/*/company.gz")
    for quarter, month in (("QTR1", 2), ("QTR2", 5)):
        _write_index(tmp_path, quarter, _companies(50, month))
        for _ in range(2):
            jobs.ingest_index(spark, glob, f"{work}/out", f"{work}/checkpoint")
        batch = read_index(spark, glob)
        stream = spark.read.schema(batch.schema).parquet(f"{work}/out").select(*batch.columns)
        assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_masked_stream_equals_batch(spark):
    work = new_dir(spark, "s")
    rows = [(i, f"Exec {i}", f"mail u{i}@x.org" if i % 2 else "none") for i in range(40)]
    frame = spark.createDataFrame(rows, "id int, executive_name string, note string")
    frame.repartition(3).write.parquet(f"{work}/in")
    config = MaskingConfig(scan_columns=("note",))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    jobs.mask_stream(stream, f"{work}/out", f"{work}/audit", f"{work}/checkpoint", "src", _as_of(), config)
    columns = frame.columns
    found = spark.read.parquet(f"{work}/out").select(*columns)
    assert found.exceptAll(masking.mask_values(frame, config)).count() == 0 and found.count() == 40
    audit = jobs.read_stream_audit(spark, f"{work}/audit").groupBy("pii_type").sum("record_count").collect()
    assert {(r[0], r[1]) for r in audit} == {("EXECUTIVE_NAME", 40), ("EMAIL", 20)}


def test_upsert_stream_keeps_the_last_state(spark):
    work = new_dir(spark, "s")
    for step in (1, 2):
        rows = [(f"id{i}", f"v{step}", datetime(2024, 1, 1 + i).date()) for i in range(step * 3)]
        frame = conform(spark.createDataFrame(rows, "id string, company_name string, filing_date date"), TRIAGE)
        frame.withColumn("created_at", F.lit(f"2024-02-0{step}").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(TRIAGE).parquet(f"{work}/in")
        jobs.upsert_stream(stream, f"{work}/gold", f"{work}/checkpoint")
    stored = {r.id: r.company_name for r in gold.read_gold(spark, f"{work}/gold").collect()}
    assert stored == {f"id{i}": "v2" for i in range(6)}


def test_stream_scores_equal_batch_scores(spark):
    work = new_dir(spark, "s")
    params = ForestParams(trees=20, sample_size=64)
    frame = spark.range(300).select(F.col("id").cast("string").alias("id"), F.randn(1).alias("a"), F.randn(2).alias("b"))
    frame.write.parquet(f"{work}/in")
    stored = spark.read.parquet(f"{work}/in")
    vector = forest.feature_vector(["a", "b"])
    with_vector = stored.withColumn("vector", vector)
    forest.fit(with_vector, "id", "vector", params).write.parquet(f"{work}/model")
    stream = spark.readStream.schema(stored.schema).parquet(f"{work}/in")
    jobs.score_stream(stream, spark.read.parquet(f"{work}/model"), vector, f"{work}/out", f"{work}/checkpoint", params)
    streamed = {r.id: r.ml_raw_score for r in spark.read.parquet(f"{work}/out").collect()}
    batch, _ = forest.fit_and_score(with_vector, "id", "vector", params)
    assert streamed == {r.id: r.ml_raw_score for r in batch.collect()}


def test_deduplicated_stream(spark):
    """A third of the rows share one key; repeats also arrive in a later file and in a later run."""
    work = new_dir(spark, "s")
    rows = [(0 if i % 3 == 0 else i % 50, f"2024-01-01 00:{i % 60:02d}:00", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "k int, ts string, n int").withColumn("ts", F.col("ts").cast("timestamp"))
    frame.repartition(3).write.parquet(f"{work}/in")
    for _ in range(2):
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
        jobs.deduplicate_stream(stream, ["k"], "ts", f"{work}/out", f"{work}/checkpoint")
        frame.limit(50).write.mode("append").parquet(f"{work}/in")
    kept = jobs.read_deduplicated(spark, f"{work}/out", frame.schema)
    assert sorted(r.k for r in kept.collect()) == sorted({k for k, _, _ in rows})
    assert kept.columns == frame.columns


def test_deduplicated_stream_with_late_rows(spark):
    """Late rows of new keys stay, those of known keys go; a key that came late first goes when it comes in time again."""
    work = new_dir(spark, "s")
    at = lambda day, hour: datetime(2024, 1, day, hour)
    batches = [
        [("a", at(1, 1), 1), ("b", at(1, 2), 2), ("none", None, 3)],
        [("c", at(9, 1), 4), ("a", at(9, 2), 5)],
        [("a", at(1, 3), 6), ("late", at(1, 4), 7), ("c", at(9, 5), 8), ("none", None, 9), (None, at(2, 1), 10)],
        [("late", at(1, 5), 11), (None, at(2, 3), 12), ("edge", at(8, 1), 13)],
        [("edge", at(8, 2), 14), ("c", at(9, 9), 15), ("d", at(9, 9), 16), ("edge", at(8, 23), 17)],
    ]
    schema = "k string, ts timestamp, n int"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in")
        jobs.deduplicate_stream(stream, ["k"], "ts", f"{work}/out", f"{work}/checkpoint")
    found = jobs.read_deduplicated(spark, f"{work}/out", spark.createDataFrame([], schema).schema)
    assert sorted(r.n for r in found.collect()) == [1, 2, 3, 4, 5, 7, 10, 13, 16]


# Registered queries ---------------------------------------------------------------------------------

def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and "severity" in frame.columns


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sf_dir, name):
    connection = check_oracle.connect(sf_dir)
    outcome = check_oracle.compare(spark, connection, name, contract.queries()[name], contract.oracle_sql().get(name), sf_dir)
    # A filter may find nothing in the smallest tables.
    assert not outcome.startswith("FAIL") or outcome == "FAIL: both are empty", outcome
