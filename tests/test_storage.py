from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.operators import cleaning
from filings_audit.schemas import BRONZE, MINIMIZED_COLUMNS, PII_LOG, RAW, SILVER, TRIAGE, conform
from filings_audit.session import new_dir, shared_dir
from filings_audit.sinks import audit_log, constraints, gold, layers
from filings_audit.sources import index_files, storage, tables


def _row(record_id, name="Quill", day=date(2024, 1, 15), cash=1, at=datetime(2024, 1, 1)):
    return (record_id, name, day, "7", "10-K", 0.1, None if cash is None else cash, True, None, 0.5, None, at)


def _frame(spark, *rows):
    loose = T.StructType([T.StructField(f.name, T.LongType() if f.name == "operating_cash_flow" else f.dataType) for f in TRIAGE.fields])
    return spark.createDataFrame(list(rows), loose)


def _state(spark, root):
    return {r.id: (r.company_name, int(r.operating_cash_flow)) for r in gold.read_gold(spark, root).collect()}


def test_upsert_replaces_inserts_keeps_and_repeats(spark):
    root = new_dir(spark, "t")
    gold.initialise(spark, root)
    assert gold.read_gold(spark, root).count() == 0 and gold.read_if_written(spark, root) is None
    gold.upsert(_frame(spark, _row("a"), _row("b"), _row("far", day=date(2023, 5, 1))), root)
    batch = _frame(
        spark, _row("b", cash=2), _row("c", cash=3, at=datetime(2024, 1, 2)), _row("c", cash=4, at=datetime(2024, 1, 3)))
    expected = {"a": ("Quill", 1), "b": ("Quill", 2), "c": ("Quill", 4), "far": ("Quill", 1)}
    for _ in range(2):
        gold.upsert(batch, root)
        assert _state(spark, root) == expected


def test_upsert_rewrites_only_the_months_it_touches(spark):
    root = new_dir(spark, "t")
    gold.upsert(_frame(spark, _row("a"), _row("old", day=date(2023, 5, 1))), root)
    before = gold._current(spark, root)[1]
    gold.upsert(_frame(spark, _row("b")), root)
    after = gold._current(spark, root)[1]
    assert after["2023-05"] == before["2023-05"] and after["2024-01"] != before["2024-01"]


def test_a_moved_date_moves_the_row(spark):
    root = new_dir(spark, "t")
    gold.upsert(_frame(spark, _row("a"), _row("b")), root)
    gold.upsert(_frame(spark, _row("a", day=date(2024, 2, 5), cash=5)), root)
    assert _state(spark, root) == {"a": ("Quill", 5), "b": ("Quill", 1)} and gold.read_gold(spark, root).count() == 2
    gold.upsert(_frame(spark, _row("b", day=date(2024, 2, 6))), root)
    assert set(gold._current(spark, root)[1]) == {"2024-02"}  # nothing is left in January


def test_an_unfinished_write_is_invisible(spark):
    root = new_dir(spark, "t")
    gold.upsert(_frame(spark, _row("a")), root)
    # Files without a log entry are what a writer leaves that died before its commit.
    lost = conform(_frame(spark, _row("a", cash=9), _row("z")), TRIAGE).withColumn("filing_month", F.lit("2024-01"))
    lost.write.partitionBy("filing_month").parquet(f"{root}/data/commit=2")
    assert _state(spark, root) == {"a": ("Quill", 1)}
    gold.upsert(_frame(spark, _row("b")), root)
    assert _state(spark, root) == {"a": ("Quill", 1), "b": ("Quill", 1)}


def test_quarantine_keeps_what_breaks_a_constraint(spark):
    root = new_dir(spark, "t")
    batch = _frame(spark, _row("a"), _row("b", name=None), _row("c", day=None), _row(None))
    for version in (1, 2):
        assert gold.upsert(batch, root) == gold.Written(version, kept=1, rejected=3)
        assert set(_state(spark, root)) == {"a"}
        rejected = sorted((r.id or "", list(r.violations)) for r in gold.read_rejected(spark, root).collect())
        assert rejected == [("", ["id"]), ("b", ["company_name"]), ("c", ["filing_date"])]


def test_rejects_stay_when_a_batch_has_no_valid_row(spark):
    root = new_dir(spark, "t")
    bad = _frame(spark, _row("x", name=None), _row("x", name=None))
    assert gold.upsert(bad, root) == gold.Written(1, kept=0, rejected=2)
    assert gold.upsert(_frame(spark, _row("a")), root) == gold.Written(2, kept=1, rejected=0)
    assert gold.append(_frame(spark, _row("a"), _row("y", name=None)), root) == gold.Written(3, kept=0, rejected=2)
    assert gold.append(_frame(spark, _row("b")), root) == gold.Written(4, kept=1, rejected=0)
    rejected = sorted((r.id, list(r.violations)) for r in gold.read_rejected(spark, root).collect())
    assert rejected == [("a", ["repeated id"]), ("x", ["company_name"]), ("x", ["company_name"]), ("y", ["company_name"])]
    assert set(_state(spark, root)) == {"a", "b"}
    # What a writer left that died before its commit is no reject.
    gold._check(_frame(spark, _row("z", name=None)), root, "lost", None)
    assert gold.read_rejected(spark, root).count() == 4


def test_append_defaults_and_ignored_columns(spark):
    root = new_dir(spark, "t")
    slim = spark.createDataFrame([("a", "Quill", date(2024, 1, 15), 9)], "id string, company_name string, filing_date date, extra int")
    assert gold.append(slim, root) == gold.Written(1, kept=1, rejected=0)
    assert gold.append(slim.withColumn("id", F.lit("b")), root) == gold.Written(2, kept=1, rejected=0)
    again = slim.unionByName(slim.withColumn("id", F.lit("c"))).unionByName(slim.withColumn("id", F.lit("c")))
    assert gold.append(again, root) == gold.Written(3, kept=1, rejected=2)
    assert {r.id: r.violations for r in gold.read_rejected(spark, root).collect()} == {"a": ["repeated id"], "c": ["repeated id"]}
    rows = gold.read_gold(spark, root).collect()
    assert {r.id for r in rows} == {"a", "b", "c"}
    assert all(r.known_rule_violation is False and r.ml_anomaly_flag is False and r.created_at for r in rows)
    assert gold.read_gold(spark, root).columns == [*TRIAGE.names, "filing_month"]
    with pytest.raises(ValueError, match="filing_date"):
        gold.append(slim.drop("filing_date"), root)


def test_date_filters_prune_partitions(spark):
    from filings_audit.operators.triage import TriageFilter, apply_filter

    root = new_dir(spark, "t")
    gold.upsert(_frame(spark, _row("a"), _row("b", day=date(2023, 5, 1)), _row("c", day=date(2024, 3, 1))), root)
    found = apply_filter(gold.read_gold(spark, root), TriageFilter(date_from=date(2023, 1, 1), date_to=date(2023, 12, 31)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(filing_month" in plan
    assert [r.id for r in found.collect()] == ["b"]


def test_constraint_report(spark):
    frame = constraints.with_defaults(_frame(spark, _row("a"), _row("a"), _row("b", name=None), _row(None)))
    report = constraints.constraint_report(frame).first()
    assert (report.records, report.duplicate_keys, report.null_company_name, report.null_id) == (4, 1, 1, 1)


def test_pii_log_is_idempotent_and_never_fatal(spark, caplog):
    path = new_dir(spark, "log")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert audit_log.read_pii_log(spark, path).collect() == []
    entries = spark.createDataFrame([("1", "run", "note", "SSN", "regex_redact", at, "live", 3)], PII_LOG)
    for _ in range(2):
        assert audit_log.write_pii_log(entries, path) == 1
    other = entries.withColumns({"source_file_id": F.lit("run:post-rca"), "id": F.lit("2")})
    assert audit_log.write_pii_log(other, path) == 1
    assert audit_log.read_pii_log(spark, path).count() == 2
    assert audit_log.write_pii_log(entries.limit(0), path) == 0
    assert audit_log.write_pii_log(entries, "nowhere://x/y") == 0
    assert "not written" in caplog.text and "SSN" not in caplog.text


def test_bronze_overwrites_only_its_quarters(spark):
    path = new_dir(spark, "bronze")
    rows = spark.createDataFrame([("1", "A", "2024", "QTR1"), ("2", "B", "2024", "QTR2")],
                                 "cik string, company_name string, edgar_year string, edgar_quarter string")
    layers.write_bronze(rows, path)
    layers.write_bronze(rows.filter("cik = '2'").withColumn("company_name", F.lit("C")), path)
    stored = tables.read_typed(spark, path, BRONZE)
    assert {(r.cik, r.company_name) for r in stored.collect()} == {("1", "A"), ("2", "C")}
    assert set(stored.columns) == set(BRONZE.names)


def test_silver_and_exports(spark):
    path = new_dir(spark, "silver")
    layers.write_silver(_frame(spark, _row("a")), path)
    assert tables.read_typed(spark, path, SILVER).columns == SILVER.names
    tricky = spark.createDataFrame([('say "hi", you', "b\\c")], "a string, b string")
    for fmt in ("csv", "parquet"):
        out = new_dir(spark, fmt)
        layers.export(tricky, out, fmt)
        back = spark.read.option("header", "true").option("escape", '"').csv(out) if fmt == "csv" else spark.read.parquet(out)
        assert [tuple(r) for r in back.collect()] == [('say "hi", you', "b\\c")]
    with pytest.raises(ValueError):
        layers.export(tricky, path, "xls")


# Sources --------------------------------------------------------------------------------------------

INDEX = [
    "Company Name".ljust(62) + "Form Type".ljust(12) + "CIK".ljust(12) + "Date Filed".ljust(12) + "File Name",
    "-" * 130,
    "",
    "  QUILL CORP".ljust(62) + "10-K".ljust(12) + "0000320193".ljust(12) + "2024-01-15".ljust(12) + "edgar/a.txt",
    "VALE LLC".ljust(62) + "4".ljust(12) + "0000000007".ljust(12) + "2024-02-30".ljust(12) + "edgar/b.txt",
    "CAFÉ SA".ljust(62) + "8-K".ljust(12) + "12".ljust(12) + "2024-03-01".ljust(12) + "edgar/c d.txt  ",
    "".ljust(62) + "8-K".ljust(12) + "13".ljust(12) + "2024-03-01".ljust(12) + "edgar/e.txt",
]


@pytest.fixture
def index_root(tmp_path):
    import gzip

    for quarter in ("QTR1", "QTR2"):
        folder = tmp_path / "full-index" / "2024" / quarter
        folder.mkdir(parents=True)
        (folder / "company.gz").write_bytes(gzip.compress("\n".join(INDEX).encode("latin-1")))
    return str(tmp_path)


def test_index_scan(spark, index_root):
    one = index_files.read_index(spark, storage.index_path(index_root, "2024", "QTR1")).collect()
    assert {(r.company_name, r.cik, r.form_type, r.filename, r.edgar_year, r.edgar_quarter) for r in one} == {
        ("QUILL CORP", "320193", "10-K", "edgar/a.txt", "2024", "QTR1"),
        ("CAFÉ SA", "12", "8-K", "edgar/c d.txt", "2024", "QTR1"),
    }
    every = index_files.read_index(spark, storage.index_path(index_root), forms=None, partitions=3)
    assert every.count() == 6
    vale = every.filter("form_type = '4'").select(cleaning.parse_date(F.col("date_filed")).alias("d")).distinct().collect()
    assert [r.d for r in vale] == [date(1900, 1, 1)]


def test_index_lines_round_trip(spark, index_root):
    rows = index_files.read_index(spark, storage.index_path(index_root), forms=None)
    lines = index_files.format_lines(rows).withColumn("path", F.concat(F.lit("/2024/"), "edgar_quarter", F.lit("/x.gz")))
    again = index_files.parse_lines(lines, forms=None)
    assert rows.exceptAll(again).count() == 0 and again.exceptAll(rows).count() == 0


def test_storage_options():
    host = "acc.dfs.core.windows.net"
    assert storage.container_root("acc", "c") == f"abfss://c@{host}"
    assert storage.container_root("acc", "c", "wasbs") == "wasbs://c@acc.blob.core.windows.net"
    assert storage.index_path(storage.container_root("acc"), "2024", "QTR1").endswith("/full-index/2024/QTR1/company.gz")
    client = ("t", "i", "s")
    keyed = storage.account_settings("acc", key="k", client=client, managed=True)
    assert keyed == {f"spark.hadoop.fs.azure.account.key.{host}": "k"}
    principal = storage.account_settings("acc", client=client, managed=True)
    assert principal[f"spark.hadoop.fs.azure.account.oauth2.client.id.{host}"] == "i" and len(principal) == 5
    managed = {f"spark.hadoop.fs.azure.account.auth.type.{host}": "ManagedIdentity"}
    assert storage.account_settings("acc", managed=True) == managed
    assert storage.account_settings("acc") == {} == storage.account_settings("", key="k")
    assert storage.settings_from({"AZURE_STORAGE_ACCOUNT": "acc", "AZURE_MANAGED_IDENTITY": "True"}) == managed
    assert storage.settings_from({"AZURE_STORAGE_ACCOUNT": "acc", "AZURE_STORAGE_KEY": "k"}) == keyed and storage.settings_from({}) == {}


def test_typed_source_and_source_switch(spark):
    path = new_dir(spark, "raw")
    rows = [{"filing_id": "1", "form_type": "10-K", "cik": "7", "company_name": "A", "filing_date": "2024-01-01",
             "revenue_usd": 1.5, "status": "Pending"}]
    spark.createDataFrame(rows).write.json(path)
    frame = tables.filings_source(spark, "intake", intake=path, fmt="json")
    assert frame.columns == RAW.names and float(frame.first().revenue_usd) == 1.5
    assert cleaning.minimize_columns(frame).columns == MINIMIZED_COLUMNS
    assert tables.filings_source(spark, "live", live=new_dir(spark, "none")).count() == 0
    with pytest.raises(ValueError):
        tables.filings_source(spark, "other")


def test_cleaning(spark):
    frame = spark.createDataFrame(
        [(None, "2024-02-30", "abc", "0007"), ("  A ", None, "NaN", "000"), ("B", "2024-02-29", "1.5", " 12 "),
         ("B", "20240115", "1d", "1"), ("B", "01/15/2024", "Infinity", "1"), ("B", "Jan 15, 2024", " -2e3 ", "1"),
         ("B", "2024", "2f", "1"), ("B", "2024-01-15T10:11:12Z", "1e999", "1"), ("B", "99999999", ".5", "1")],
        "n string, d string, x string, c string")
    rows = frame.select(
        cleaning.company_or_unknown(F.col("n")).alias("n"), cleaning.parse_date(F.col("d")).alias("d"),
        cleaning.to_number(F.col("x")).alias("x"), cleaning.strip_cik(F.col("c")).alias("c")).collect()
    assert [tuple(r) for r in rows] == [
        ("Unknown", date(1900, 1, 1), None, "7"), ("A", date(1900, 1, 1), None, ""), ("B", date(2024, 2, 29), 1.5, "12"),
        ("B", date(2024, 1, 15), None, "1"), ("B", date(2024, 1, 15), None, "1"), ("B", date(2024, 1, 15), -2000.0, "1"),
        ("B", date(1900, 1, 1), None, "1"), ("B", date(2024, 1, 15), None, "1"), ("B", date(1900, 1, 1), 0.5, "1")]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_shared_dir_without_a_setting_is_in_the_warehouse():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "hdfs://x/warehouse/"}.get(name, default))

    assert shared_dir(Session) == "hdfs://x/warehouse"


def test_warehouse_reads(spark):
    from filings_audit.operators.triage import TriageFilter
    from filings_audit.plans.reads import NotFound, Warehouse

    root = new_dir(spark, "w")
    store = Warehouse(spark, root)
    assert store.filings().count() == 0 and store.pii_audit().count() == 0
    assert store.stats() == {"total": 0, "violations": 0, "anomalies": 0, "healthy": 0}
    rows = [_row(f"r{i}", name=f"Company {i % 3}", at=datetime(2024, 1, 1 + i)) for i in range(25)]
    gold.upsert(_frame(spark, *rows), f"{root}/gold")
    assert [r.id for r in store.filings(2).collect()] == ["r24", "r23"]
    assert store.filing("r3").first().company == "Company 0"
    with pytest.raises(NotFound):
        store.filing("none")
    assert store.stats() == {"total": 25, "violations": 25, "anomalies": 0, "healthy": 0}
    view = store.view(TriageFilter(search="company 1", severity="violation"), sort="company", page=1, size=3)
    assert [r.id for r in view.collect()] == ["r22", "r19", "r16"]
