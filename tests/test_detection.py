import hashlib
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from filings_audit.operators import detection, explain, keyed


@pytest.mark.parametrize("growth,cash,expected", [
    (0.21, -0.01, True), (0.20, -1.0, False), (0.21, 0.0, False), (None, -1.0, False),
    (float("nan"), -1.0, False), (0.5, None, False),
])
def test_rule(one, growth, cash, expected):
    row = one((growth, cash), "g double, c double",
              hit=detection.rule_violation(F.col("g"), F.col("c").cast("decimal(20,2)")))
    assert row["hit"] is expected


def test_features(spark):
    growth = [0.1, 0.3, None, -0.2, 0.05]
    frame = spark.createDataFrame([(i, g, 5e9 if i else None) for i, g in enumerate(growth)],
                                  "id int, revenue_growth double, operating_cash_flow double")
    rows = {r.id: r for r in detection.with_features(frame).collect()}
    present = [g for g in growth if g is not None]
    mean, std = statistics.mean(present), statistics.stdev(present)
    assert rows[1].revenue_growth_norm == pytest.approx((0.3 - mean) / (std + 1e-9))
    assert rows[2].revenue_growth_norm is None
    assert rows[0].operating_cash_flow_norm == 0.0 and rows[1].operating_cash_flow_norm == 0.5


def test_single_row_has_no_spread(spark):
    frame = spark.createDataFrame([(0.1, 1.0)], "revenue_growth double, operating_cash_flow double")
    assert detection.with_features(frame).first().revenue_growth_norm is None


@pytest.mark.parametrize("share", [0.01, 0.08, 0.5, 0.999])
def test_quantile_is_exact(spark, share):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(size=1001), 2)
    values[:400] = 0.25  # one value holds a large share
    frame = spark.createDataFrame([(float(v),) for v in values], "s double").repartition(7)
    found = detection.quantile(frame, "s", share).first().threshold
    assert found == pytest.approx(np.quantile(values, share), abs=1e-12)


def test_flags_and_normalised_scores(spark):
    raw = [-0.9, -0.5, -0.5, -0.4, -0.3, -0.3, -0.2, -0.2, -0.1, -0.1]
    frame = spark.createDataFrame([(i, r, 0.5, -1.0 if i == 9 else 1.0) for i, r in enumerate(raw)],
                                  "id int, ml_raw_score double, revenue_growth double, operating_cash_flow double")
    rows = {r.id: r for r in detection.live_flags(frame, 0.1).collect()}
    assert [i for i in rows if rows[i].ml_anomaly_flag] == [0]
    assert rows[0].ml_anomaly_score == pytest.approx(1.0, abs=1e-6) and rows[9].ml_anomaly_score == 0.0
    priority = {r.id: r.triage_priority for r in detection.dual_layer(frame, 0.1).collect()}
    assert priority[0] == 1 and priority[9] == 1 and priority[5] == 0


def test_late_filing(one):
    row = one(("2024-01-01", "2024-03-02"), "a string, b string",
              late=detection.late_filing(F.col("a").cast("date"), F.col("b").cast("date"), 60),
              on_time=detection.late_filing(F.col("a").cast("date"), F.col("b").cast("date"), 61))
    assert row == {"late": True, "on_time": False}


def test_messages_use_measured_numbers_and_are_stable(spark):
    rows = [(str(i), i % 3 == 0, i % 3 == 1, 0.314, 2.72, 0.0415, 0.87) for i in range(60)]
    schema = ("id string, known_rule_violation boolean, ml_anomaly_flag boolean, revenue_growth double, "
              "revenue_growth_norm double, operating_cash_flow_norm double, ml_anomaly_score double")
    frame = spark.createDataFrame(rows, schema)
    first = {r.id: r.root_cause_message for r in explain.with_root_cause(frame).collect()}
    again = {r.id: r.root_cause_message for r in explain.with_root_cause(frame.repartition(5)).collect()}
    assert first == again
    assert {first[str(i)] for i in range(0, 60, 3)} == set(explain.RULE_TEXTS)
    filled = {t.format(growth="31.4", sigma="2.7", ratio="0.042", score="0.87") for t in explain.MODEL_TEXTS}
    assert {first[str(i)] for i in range(1, 60, 3)} == filled
    assert all(first[str(i)] is None for i in range(2, 60, 3))


def test_every_message_is_chosen_by_the_md5_of_some_id(spark):
    schema = ("id string, known_rule_violation boolean, ml_anomaly_flag boolean, revenue_growth double, "
              "revenue_growth_norm double, operating_cash_flow_norm double, ml_anomaly_score double")
    for rule, texts in ((True, explain.RULE_TEXTS), (False, explain.MODEL_TEXTS)):
        frame = spark.createDataFrame([(str(i), rule, True, 0.314, 2.72, 0.0415, 0.87) for i in range(60)], schema)
        filled = [t.format(growth="31.4", sigma="2.7", ratio="0.042", score="0.87") for t in texts]
        for row in explain.with_root_cause(frame).collect():
            assert row.root_cause_message == filled[int(hashlib.md5(row.id.encode()).hexdigest(), 16) % len(texts)]
        assert {r.root_cause_message for r in explain.with_root_cause(frame).collect()} == set(filled)


# Keyed operators on one hot key ---------------------------------------------------------------------

def test_previous_value_equals_a_plain_lag(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        key = 1 if i % 3 == 0 else int(rng.integers(2, 60))  # a third of all rows share one key
        rows.append((key, f"2024-01-{int(rng.integers(1, 29)):02d}", i, float(rng.integers(1, 99)) if i % 17 else None))
    frame = spark.createDataFrame(rows, "k int, d string, seq int, v double").withColumn("d", F.col("d").cast("date"))
    found = {r.seq: r.p for r in keyed.previous_value(frame.repartition(6), "k", "d", "seq", "v", "p").collect()}
    last: dict = {}
    for key, _, seq, value in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        assert found[seq] == last.get(key)
        last[key] = value
    assert len(found) == len(rows)


def test_latest_per_key_limits_before_the_shuffle(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "k string, v int").repartition(6)
    latest = keyed.latest_per_key(frame, "k", F.desc("v"))
    expected: dict = {}
    for key, value in rows:
        expected[key] = max(value, expected.get(key, -1))
    assert {r.k: r.v for r in latest.collect()} == expected
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_left_join_keeps_filings_without_facts(spark):
    filings = spark.createDataFrame([("1", "a"), ("2", "b"), ("1", "c")], "cik string, id string")
    facts = spark.createDataFrame([("1", 5)], "cik string, amount int")
    assert {(r.id, r.amount) for r in keyed.attach_facts(filings, facts).collect()} == {("a", 5), ("b", None), ("c", 5)}
    assert {r.id for r in keyed.without_ids(filings, filings.filter("cik = '1'")).collect()} == {"b"}


def test_a_hot_key_is_split_in_the_join(spark):
    """Adaptive execution divides the partition that one key overfills; every row is still joined."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        number = F.col("id")
        key = F.when(number % 3 == 0, F.lit("hot")).otherwise((number % 500).cast("string"))
        filings = spark.range(0, 60_000, 1, 12).select(key.alias("cik"), F.sha2(number.cast("string"), 256).alias("v"))
        facts = spark.range(500).select(F.col("id").cast("string").alias("cik"), F.col("id").alias("n")).union(
            spark.createDataFrame([("hot", -1)], "cik string, n long"))
        joined = keyed.attach_facts(filings, facts)
        counts = joined.groupBy((F.col("n") < 0).alias("hot"))
        assert joined.filter("n is null").count() == 0
        assert {(r.hot, r["count"]) for r in counts.count().collect()} == {(True, 20_000), (False, 40_000)}
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["plain", "ties", "few", "one"])
def test_quantiles_from_sketches_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(detection, "LAST_VALUES", 60)
    monkeypatch.setattr(detection, "SKETCH", 64)
    monkeypatch.setattr(detection, "MARGIN", 0.02)  # below the error of so small a sketch: bounds must be widened
    r = np.random.default_rng(5)
    values = {"plain": r.normal(size=20_000), "ties": np.round(r.normal(size=20_000) * 4), "few": np.array([3.0, -1.0, 2.0]), "one": np.full(9000, 7.0)}[kind]
    rows = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    frame = spark.createDataFrame(rows, "v double").repartition(6).cache()
    for share in (0.0, 0.01, 0.5, 0.77, 1.0):
        found = detection.quantile(frame, "v", share).first()[0]
        assert found == pytest.approx(np.quantile(values, share), abs=1e-12), share
    assert detection.quantile(frame.limit(0), "v", 0.5).first()[0] is None


def test_a_new_partition_adds_its_own_sketch(spark):
    r = np.random.default_rng(6)
    frame = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(r.normal(size=9000))], "q int, v double").cache()
    stored = detection.sketches(frame.filter("q < 2"), "v", ["q"]).unionByName(detection.sketches(frame.filter("q = 2"), "v", ["q"]))
    assert sorted((row.q, row.n) for row in stored.collect()) == [(0, 3000), (1, 3000), (2, 3000)]
    for upto in (1, 2):
        some = frame.filter(F.col("q") <= upto)
        wanted = np.quantile([row.v for row in some.collect()], 0.08)
        assert detection.quantile(some, "v", 0.08, stored.filter(F.col("q") <= upto)).first()[0] == pytest.approx(wanted, abs=1e-12)
