import pytest
from pyspark.sql import functions as F

from filings_audit.operators import search
from filings_audit.session import new_dir

NAMES = ["Quill & Co", "QUILL", "100% Pure_Gold", "a", "", None, "ab", "Straße 7", "naïve%", "x_y", "Quilt"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(str(i), name, f"2024-0{i % 3 + 1}", i) for i, name in enumerate(NAMES)] + [(f"c{i}", f"Common {i}", "2024-02", i) for i in range(300)]
    path = new_dir(spark, "names")
    frame = spark.createDataFrame(rows, "id string, company_name string, filing_month string, n int")
    frame.write.partitionBy("filing_month").parquet(f"{path}/table")
    stored = spark.read.parquet(f"{path}/table")
    search.write_index(stored, f"{path}/index")
    return stored, f"{path}/index"


@pytest.mark.parametrize("text", ["quill", "QUIL", "%", "_", "e_g", "a", "AB", "é", "ße", "mon 29", "uill & c", "zzz", "com", "7", " ", "quillt", ""])
def test_as_a_scan_finds(table, text):
    stored, index = table
    wanted = {r.id for r in stored.filter(F.lower("company_name").contains(text.lower())).collect()} if text else {r.id for r in stored.collect()}
    found = search.search(stored, index, text)
    assert found.columns == stored.columns and {r.id for r in found.collect()} == wanted


def test_only_partitions_with_candidates_are_read(table):
    stored, index = table
    plan = search.search(stored, index, "quilt")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-02" in filters and "2024-01" not in filters


def test_an_empty_table(spark):
    frame = spark.createDataFrame([], "id string, company_name string, filing_month string")
    path = new_dir(spark, "none")
    search.write_index(frame, path)
    assert search.search(frame, path, "abc").collect() == [] == search.search(frame, path, "a").collect()
