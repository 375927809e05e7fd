from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filings_audit.operators import forest, models, triage
from filings_audit.operators.masking import MaskingConfig
from filings_audit.plans import standing
from filings_audit.schemas import TRIAGE, conform
from filings_audit.session import file_system, new_dir
from filings_audit.sinks import gold, rotation
from filings_audit.streaming import jobs


def _rows(spark, *rows):
    """(id, day, created, rule, ml, score)"""
    full = [(i, "Quill", day, None, None, None, None, rule, ml, score, None, at) for i, day, at, rule, ml, score in rows]
    return spark.createDataFrame(full, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIAGE.fields))


def _month(n):
    return date(2024, n, 5)


BATCHES = [
    [("a", _month(1), datetime(2024, 1, 6), True, False, 0.25), ("b", _month(1), datetime(2024, 1, 7), False, False, None)],
    [("c", _month(2), datetime(2024, 2, 6), False, True, 0.5), ("d", _month(3), datetime(2024, 3, 6), True, True, 0.1234)],
    [("a", _month(3), datetime(2024, 3, 7), False, False, 0.75), ("b", _month(3), datetime(2024, 3, 8), False, True, 0.1)],  # January ends
    [("e", _month(2), datetime(2024, 3, 6), None, None, None), ("f", None, datetime(2024, 3, 6), True, True, 1.0)],  # f is refused
]


def _same(spark, root):
    table = gold.read_gold(spark, root)
    assert standing.summary(spark, root, True).collect() == triage.summary(table, True).collect()
    for limit in (1, 3, 1000):
        expected = [r.id for r in triage.newest(table, limit).collect()]
        assert [r.id for r in standing.newest(spark, root, limit).collect()] == expected


def test_counts_follow_every_change(spark):
    root = new_dir(spark, "t")
    _same(spark, root)
    gold.initialise(spark, root)
    _same(spark, root)
    for batch in BATCHES:
        gold.upsert(_rows(spark, *batch), root)
        _same(spark, root)
    gold.append(_rows(spark, *BATCHES[1]), root)  # all refused
    _same(spark, root)


def test_a_summary_reads_no_record_and_the_newest_their_month(spark):
    root = new_dir(spark, "t")
    months = lambda limit: {f.split("filing_month=")[1].split("/")[0] for f in standing.newest(spark, root, limit).inputFiles()}
    for batch in BATCHES[:3]:
        gold.upsert(_rows(spark, *batch), root)
    files = standing.summary(spark, root).inputFiles()
    assert files and not any("/data/" in f for f in files)
    assert months(2) == {"2024-03"} and months(4) == {"2024-02", "2024-03"}
    gold.upsert(_rows(spark, *BATCHES[3]), root)
    assert months(2) == {"2024-02", "2024-03"}  # a row of February is as late as March's first


def test_counts_of_a_dead_writer_and_a_table_without_counts(spark):
    root = new_dir(spark, "t")
    gold.upsert(_rows(spark, *BATCHES[0]), root)
    lost = conform(_rows(spark, *BATCHES[1]), TRIAGE).withColumn("location", F.lit(f"{root}/data/commit=2/filing_month=2024-02"))
    gold.month_counts.note(lost, root, 2)  # its writer died before the log named the folder
    _same(spark, root)
    gold.upsert(_rows(spark, *BATCHES[1]), root)
    _same(spark, root)
    fs, path = file_system(spark, f"{root}/months/commit=1")
    fs.delete(path, True)
    _same(spark, root)


def test_a_limit_out_of_range(spark):
    with pytest.raises(ValueError):
        standing.newest(spark, new_dir(spark, "t"), 0)


# Rotation -----------------------------------------------------------------------------------------

CONFIG = MaskingConfig(hash_columns=("name",), scan_columns=())


def _files(spark, path):
    return {(r.q, r.f) for r in spark.read.parquet(path).select("q", F.input_file_name().alias("f")).distinct().collect()}


def test_rotation_is_taken_up_where_it_stopped(spark):
    work = new_dir(spark, "t")
    rows = [(i, f"n{i % 3}" if i % 4 else None, f"Q{i % 3}") for i in range(30)]
    spark.createDataFrame(rows, "i long, name string, q string").write.partitionBy("q").parquet(f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")
    turn = lambda salt, version, **kw: rotation.rotate(raw, f"{work}/masked", CONFIG, salt, version, ("q",), **kw)
    assert turn("s1", "v1", together=2) == [("Q0",), ("Q1",), ("Q2",)] and turn("s1", "v1") == []
    old = _files(spark, f"{work}/masked")
    assert turn("s2", "v2", at_most=1) == [("Q0",)]
    half = _files(spark, f"{work}/masked")
    assert {q for q, _ in half & old} == {"Q1", "Q2"} and {q for q, _ in half - old} == {"Q0"}
    assert turn("s2", "v2") == [("Q1",), ("Q2",)]
    assert {q for q, _ in _files(spark, f"{work}/masked") & half} == {"Q0"}
    whole = rotation.masking.remask(raw, CONFIG, "s2", "v2")
    stored = rotation.read_masked(spark, f"{work}/masked", raw.schema).select(*whole.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))


def test_a_quarter_of_two_versions_is_outdated(spark):
    work = new_dir(spark, "t")
    raw = spark.createDataFrame([(1, "n", "Q0"), (2, "n", "Q1")], "i long, name string, q string")
    mixed = spark.createDataFrame([(1, "v2", "Q0"), (2, None, "Q0"), (3, "v2", "Q1")], "i long, masking_version string, q string")
    mixed.write.partitionBy("q").parquet(f"{work}/masked")
    assert [r.q for r in rotation.outdated(raw, f"{work}/masked", "v2", ("q",)).collect()] == ["Q0"]


# Models -------------------------------------------------------------------------------------------

def test_a_replayed_batch_keeps_its_model(spark):
    work = new_dir(spark, "t")
    rows = spark.createDataFrame([(i, [float(i % 7), float(i)]) for i in range(40)], "id long, v array<double>")
    rows.coalesce(1).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
    run = lambda checkpoint: jobs.score_by_newest(stream, f"{work}/models", F.col("v"), f"{work}/out", f"{work}/{checkpoint}")
    seen = lambda: jobs.read_scored(spark, f"{work}/out", rows.schema)
    with pytest.raises(Exception, match="no model"):
        run("first")
    assert seen().count() == 0
    fits = [forest.ForestParams(trees=5, sample_size=16, seed=seed) for seed in (1, 2)]
    models.publish(forest.fit(rows, "id", "v", fits[0]), f"{work}/models", 1, fits[0])
    run("first")
    before = sorted(map(str, seen().collect()))
    assert {(r.model_version, r.epoch) for r in seen().collect()} == {(1, 0)} and len(before) == 40
    models.publish(forest.fit(rows, "id", "v", fits[1]), f"{work}/models", 2, fits[1])
    run("second")  # the same micro-batch again, as after a crash before its commit
    assert sorted(map(str, seen().collect())) == before
    rows.withColumn("id", F.col("id") + 100).coalesce(1).write.mode("append").parquet(f"{work}/in")
    run("first")
    assert {(r.model_version, r.epoch) for r in seen().collect()} == {(1, 0), (2, 1)} and seen().count() == 80
