"""What a job does per row, task and file must not grow faster than its input."""

import glob
import re

from pyspark.sql import functions as F

from filings_audit.operators import explain, forest, search
from filings_audit.session import materialize, new_dir
from filings_audit.sinks import gold
from filings_audit.sources import index_files, star_schema
from filings_audit.streaming import jobs
from filings_audit.workload import detection_queries, fixture, storage


def _method_sizes(frame) -> list[int]:
    """Bytes of the longest method of each generated stage."""
    debug = getattr(getattr(frame.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    text = debug.codegenString(frame._jdf.queryExecution().executedPlan())
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_code_per_row_is_short_enough_to_be_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        schema = ("id string, known_rule_violation boolean, ml_anomaly_flag boolean, revenue_growth double, "
                  "revenue_growth_norm double, operating_cash_flow_norm double, ml_anomaly_score double")
        rows = materialize(spark.createDataFrame([("1", False, True, 0.1, 0.2, 0.3, 0.4)], schema), "code")
        sizes = _method_sizes(explain.with_root_cause(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) <= 8000
    # Longer stages are generated in smaller methods.
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_the_index_cuts_a_name_once(spark):
    path = new_dir(spark, "names")
    rows = spark.range(500).select(
        F.col("id").cast("string").alias("id"), F.lit("Quill & Co").alias("company_name"), F.concat(F.lit("2024-0"), F.col("id") % 3 + 1).alias("filing_month"))
    rows.write.partitionBy("filing_month").parquet(f"{path}/table")
    stored = spark.read.parquet(f"{path}/table")
    search.write_index(stored, f"{path}/index")
    assert spark.read.parquet(f"{path}/index/grams").count() == len("Quill & Co") + 2
    assert search.search(stored, f"{path}/index", "QUILL").count() == 500


def test_rejects_stream_is_not_written_by_one_task(spark, sf_dir, monkeypatch):
    seen, stream = [], storage._stream
    monkeypatch.setattr(storage, "_stream", lambda spark, path, *args, **more: seen.append(path) or stream(spark, path, *args, **more))
    monkeypatch.setattr(jobs, "upsert_stream", lambda *args: None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        storage.stream_rejects(spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(glob.glob(f"{seen[0].removeprefix('file:')}/*.parquet")) > 2


def test_upsert_stream_has_more_files_of_more_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(storage, "_FILE_ROWS", 200)
    seen, stream = [], storage._stream
    monkeypatch.setattr(storage, "_stream", lambda spark, path, schema, files: seen.append((path, files)) or stream(spark, path, schema, files))
    assert storage.stream_upsert(spark, sf_dir).count() == fixture.scored(spark, sf_dir).count()
    (path, per_batch), = seen
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.parquet")) == 3 * per_batch > 3


def test_a_revision_and_its_older_copy_come_from_one_join(spark, sf_dir):
    plan = storage._revised(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == 2


def test_depths_add_no_rows_and_no_shuffle(spark):
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), F.array(F.sqrt("id"), F.sin("id")).alias("vector"))
    rows = materialize(rows, "vectors")
    scored, model = forest.fit_and_score(rows, "id", "vector", forest.ForestParams(trees=9, sample_size=32))
    told = forest.depths(scored, model, "vector")
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    long = forest.tree_depths(scored, "id", model, "vector").groupBy("id").agg(F.sum("depth").alias("sum"), F.count("*").alias("n"))
    for row in told.join(long, "id").collect():
        assert len(row.depths) == row.n == 9 and abs(sum(row.depths) - row["sum"]) < 1e-9


def test_a_line_is_searched_for_its_quarter_once(spark):
    values = ["Comments:  none", "Company Name  Form Type  CIK", "Quill: Co".ljust(62) + "10-K".ljust(12) + "12".ljust(12) + "2024-02-01".ljust(12) + "e/1.txt", "odd", " "]
    paths = ["file:/a/2024/QTR1/company.gz", "file:/a/edgar_year=2023/edgar_quarter=QTR4/x/part.gz", "file:/edgar_year=2023/edgar_quarter=QTR4/part.gz", "/2022/QTR5/x"]
    lines = spark.createDataFrame([(v, p) for v in values for p in paths], "value string, path string")
    rows = index_files.classify_lines(lines)
    assert {(r.path, r.edgar_year, r.edgar_quarter) for r in rows.collect()} == set(
        zip(paths, ["2024", "", "2023", ""], ["QTR1", "", "QTR4", ""]))
    assert [r.kind for r in rows.filter(F.col("path") == paths[0]).collect()] == ["header", "header", "entry", "damaged", "blank"]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1


def test_facts_are_grouped_before_the_cash_flow_is_attached(spark, sf_dir):
    found = detection_queries._facts(spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
    wanted = star_schema.filings(spark, sf_dir).groupBy(F.regexp_replace("cik", "^0+", "").alias("cik")).agg(
        F.max("revenue_usd").alias("revenue_usd"), F.max("operating_cash_flow").alias("operating_cash_flow"),
        F.max_by("revenue_growth", "order_key").alias("revenue_growth"), F.max("executive_name").alias("executive_name"))
    assert found.schema == wanted.schema
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()


def test_a_stored_batch_is_not_copied(spark):
    rows = [(str(i), f"Company {i}" if i % 4 else None) for i in range(20)]
    batch = materialize(spark.createDataFrame(rows, "id string, company_name string").withColumn("filing_date", F.lit("2024-02-01").cast("date")), "batch")
    root = new_dir(spark, "gold")
    checked, counts = gold._check(batch, root, "one", fixture.as_of(), stored=True)
    assert (counts["kept"], counts["refused"]) == (15, 5)
    assert checked.filter("refused").count() == 5 and checked.count() == 20
    folder = f"{root}/batches/one".removeprefix("file:")
    assert glob.glob(f"{folder}/refused=true/*.parquet") and not glob.glob(f"{folder}/refused=false")
    copied = gold.upsert(batch, f"{root}/copied", fixture.as_of(), unique=True)
    written = gold.upsert(batch, f"{root}/stored", fixture.as_of(), unique=True, stored=True)
    assert written == copied and (written.kept, written.rejected) == (15, 5)
    for read in (gold.read_gold, gold.read_rejected):
        one, other = read(spark, f"{root}/copied"), read(spark, f"{root}/stored")
        assert one.count() == other.count() and one.exceptAll(other).isEmpty()
    # The same batch again is told by its name: its refused rows count once.
    gold.upsert(batch, f"{root}/stored", fixture.as_of(), unique=True, stored=True)
    assert gold.read_rejected(spark, f"{root}/stored").count() == 5
