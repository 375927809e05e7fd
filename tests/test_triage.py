import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filings_audit.functions import scores, shaping
from filings_audit.operators import triage
from filings_audit.operators.triage import TriageFilter
from filings_audit.schemas import TRIAGE

NAMES = ["Acme", "acme", "Bolt", "bolt 100%", "a_b", "Zeta", "éclair", ""]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = []
    for i in range(157):
        rule, ml = rng.random() < 0.2, rng.random() < 0.3
        made.append((
            str(i), rng.choice(NAMES), date(2024, 1, 1) + timedelta(days=rng.randrange(60)), rng.choice(["7", "", None]),
            rng.choice(["10-K", "8-K", None]), rng.choice([None, 0.5, -0.1]), None, rule, ml,
            round(rng.random(), 4), "text" if rule or ml else None,
            datetime(2024, 3, 1) + timedelta(minutes=rng.randrange(40)),
        ))
    return made


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, TRIAGE).repartition(5).cache()


@pytest.fixture(scope="module")
def records(table):
    return triage.to_records(table).cache()


@pytest.mark.parametrize("rule,ml,expected", [
    (True, True, ("Rule Violation", "violation", "Needs Review", "Pending")),
    (True, False, ("Rule Violation", "violation", "Needs Review", "Pending")),
    (False, True, ("ML Anomaly", "anomaly", "In Progress", "Pending")),
    (False, False, ("None", "healthy", "Resolved", "Resolved")),
])
def test_issue_precedence(one, rule, ml, expected):
    r, m = F.col("r"), F.col("m")
    row = one((rule, ml), "r boolean, m boolean", a=shaping.issue_type(r, m), b=shaping.severity(r, m),
              c=shaping.review_status(r, m), d=shaping.workflow_status(r, m))
    assert tuple(row.values()) == expected


@pytest.mark.parametrize("record_id,score,number,hours,token,seat", [
    ("7", 0.9, 555, 52, "2d", 7), ("7", 0.6, 555, 11, "11h", 7),
    ("12", 0.55, 112, 149, "6d", 4), ("3", 0.8, 883, 172, "7d", 3),
])
def test_age_and_assignee_golden(one, record_id, score, number, hours, token, seat):
    from filings_audit.functions.identity import md5_mod

    key, s = F.col("k"), F.col("s")
    age = shaping.alert_age_hours(key, s)
    row = one((record_id, score), "k string, s double", number=md5_mod(key, 1000), hours=age,
              token=shaping.age_token(age), who=shaping.assignee(key), back=shaping.token_hours(shaping.age_token(age)))
    assert (row["number"], row["hours"], row["token"]) == (number, hours, token)
    assert row["who"] == shaping.ASSIGNEES[seat]
    assert row["back"] == (hours if hours < 24 else hours // 24 * 24)


def test_routing_of_text_ids_is_stable(one):
    import hashlib

    key = "6926b648-27bf-5539-9ff9-a2797242904c"
    row = one((key, "0001193125-24-000007"), "k string, a string",
              k=shaping.routing_number(F.col("k")), a=shaping.routing_number(F.col("a")))
    assert int(row["k"]) == int(hashlib.md5(key.encode()).hexdigest(), 16) % 10000
    assert int(row["a"]) == 1193125


@pytest.mark.parametrize("score,band,text", [
    (0.8, "Cluster-7 (High-Risk)", "0.76 – 0.84"), (0.5, "Cluster-3 (Medium-Risk)", "0.46 – 0.54"),
    (0.4999, "Cluster-2 (Low-Risk)", "0.46 – 0.54"), (0.01, "Cluster-2 (Low-Risk)", "0.00 – 0.05"),
    (0.99, "Cluster-7 (High-Risk)", "0.95 – 1.00"),
])
def test_bands_and_interval(one, score, band, text):
    row = one((score,), "s double", band=scores.risk_cluster(F.col("s")), text=scores.score_interval(F.col("s"))[2])
    assert row == {"band": band, "text": text}


def test_texts(one):
    row = one(("1234567890.00", "-994280000.00", None, ""), "a string, b string, n string, e string",
              a=shaping.billions_text(F.col("a").cast("decimal(20,2)")), b=shaping.billions_text(F.col("b").cast("decimal(20,2)")),
              n=shaping.billions_text(F.col("n").cast("decimal(20,2)")), d=shaping.dollars_text(F.col("b").cast("decimal(20,2)")),
              p=shaping.percent_text(F.lit(0.1234)), r=shaping.cash_ratio(F.col("a").cast("decimal(20,2)")),
              r0=shaping.cash_ratio(F.col("n").cast("decimal(20,2)")), na=shaping.or_not_available(F.col("e")),
              date=shaping.date_text(F.lit(None).cast("date")), bad=shaping.token_hours(F.lit("—")),
              old=shaping.is_urgent(F.lit("2d")), new=shaping.is_urgent(F.lit("47h")))
    assert row == {"a": "$1.2B", "b": "$-1.0B", "n": None, "d": "-$994,280,000.00", "p": "12.3%", "r": 0.123,
                   "r0": 0.0, "na": "N/A", "date": "N/A", "bad": 0, "old": True, "new": False}


def test_top_feature_ties_go_to_the_first(one):
    def of(*values):
        names = ("revenueGrowthDelta", "cashFlowRatio", "filingFrequency")
        return shaping.top_feature(F.struct(*[F.lit(v).alias(n) for v, n in zip(values, names)]))

    row = one((1,), "x int", a=of(-0.5, 0.5, 0.1), b=of(0.1, -0.7, 0.1), c=of(0.0, 0.0, 0.2))
    assert list(row.values()) == ["revenueGrowthDelta", "cashFlowRatio", "filingFrequency"]


def test_record_shape(records):
    row = records.filter("needsTriage").first()
    assert row.mlTelemetry.modelVersion == shaping.MODEL_VERSION
    assert set(row.mlTelemetry.featureContrib.asDict()) == {"revenueGrowthDelta", "cashFlowRatio", "filingFrequency"}
    healthy = records.filter("not needsTriage").first()
    assert healthy.assignee is None and healthy.alertAge is None and healthy.cik in ("7", "N/A")


def _expected_order(records, key, descending):
    rows = sorted(records.collect(), key=lambda r: int(r.id) * 0 + 0)
    rows = sorted(rows, key=lambda r: r.id)
    rows = sorted(rows, key=lambda r: r.created_at, reverse=True)

    def hours(token):
        return 0 if not token else int(token[:-1]) * (24 if token.endswith("d") else 1)

    value = {
        "company": lambda r: r.company, "formType": lambda r: r.formType, "filingDate": lambda r: r.filingDate,
        "issueType": lambda r: shaping.SEVERITY_RANK[r.severity], "status": lambda r: shaping.STATUS_RANK[r.status],
        "anomalyScore": lambda r: r.mlTelemetry.anomalyScore, "rootCause": lambda r: r.violationDetails or "",
        "assignee": lambda r: r.assignee or "", "alertAge": lambda r: hours(r.alertAge), None: lambda r: 0,
    }[key]
    ordered = sorted(rows, key=value, reverse=descending)
    if descending:  # ties keep the base order in both directions
        ordered = [r for v in sorted({value(r) for r in rows}, reverse=True) for r in rows if value(r) == v]
    return [r.id for r in ordered]


@pytest.mark.parametrize("key", [None, *triage.SORT_KEYS])
@pytest.mark.parametrize("descending", [False, True])
def test_sorts(records, key, descending):
    found = [r.id for r in triage.sort_records(records, key, descending).collect()]
    assert found == _expected_order(records, key, descending if key else False)


@pytest.mark.parametrize("reach", [10, 35, 100_000])
@pytest.mark.parametrize("number", [0, 1, 2, 8, 15, 16, 99])
def test_pages_near_deep_and_past_the_end(records, number, reach):
    order = _expected_order(records, "status", True)
    page = max(1, min(number, 16))
    found = [r.id for r in triage.page(records, number, "status", True, reach=reach).collect()]
    assert found == order[(page - 1) * 10 : page * 10]


def test_empty_view_has_one_empty_page(records):
    assert triage.page(records.limit(0), 3, "company").collect() == []


def test_collation_orders_like_a_reader(records):
    names = [r.company for r in triage.sort_records(records, "company", collation="UNICODE").select("company").distinct().collect()]
    ordered = list(dict.fromkeys(r.company for r in triage.sort_records(records, "company", collation="UNICODE").collect()))
    assert set(names) == set(ordered)
    assert ordered.index("éclair") < ordered.index("Zeta") and ordered.index("Bolt") < ordered.index("éclair")


@pytest.mark.parametrize("wanted,keep", [
    (TriageFilter(search="ACME"), lambda r: "acme" in r[1].lower()),
    (TriageFilter(search="%"), lambda r: "%" in r[1]),
    (TriageFilter(search="_"), lambda r: "_" in r[1]),
    (TriageFilter(severity="violation"), lambda r: r[7]),
    (TriageFilter(severity="anomaly"), lambda r: r[8] and not r[7]),
    (TriageFilter(severity="healthy"), lambda r: not r[8] and not r[7]),
    (TriageFilter(needs_review=True), lambda r: r[7] or r[8]),
    (TriageFilter(rule=True, ml=True), lambda r: r[7] and r[8]),
    (TriageFilter(date_from=date(2024, 1, 10), date_to=date(2024, 2, 1)), lambda r: date(2024, 1, 10) <= r[2] <= date(2024, 2, 1)),
    (TriageFilter("b", "anomaly", True, date(2024, 1, 5)), lambda r: "b" in r[1].lower() and r[8] and not r[7] and r[2] >= date(2024, 1, 5)),
    (TriageFilter(), lambda r: True),
])
def test_filters(table, rows, wanted, keep):
    expected = {r[0] for r in rows if keep(r)}
    assert {r.id for r in triage.apply_filter(table, wanted).collect()} == expected
    assert triage.matching_count(table, wanted).first().matching == len(expected)


def test_summary_ignores_filters_and_counts_double_flags_once(table, rows):
    found = triage.summary(table, with_average=True).first()
    assert found.total == len(rows)
    assert found.violations == sum(r[7] for r in rows) and found.anomalies == sum(r[8] for r in rows)
    assert found.healthy == sum(not r[7] and not r[8] for r in rows)
    assert found.average_score == pytest.approx(sum(r[9] for r in rows) / len(rows), abs=1e-6)


def test_limits_and_lookup(table, rows):
    newest = [r.id for r in triage.newest(table, 5).collect()]
    assert newest == [r[0] for r in sorted(sorted(rows, key=lambda r: r[0]), key=lambda r: r[11], reverse=True)][:5]
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            triage.newest(table, bad)
    assert triage.lookup(table, "42").first().id == "42" and triage.lookup(table, "none").count() == 0


def test_records_as_json(records):
    import json

    row = triage.as_json(records.filter("id = '7'")).first()
    parsed = json.loads(row.record)
    assert parsed["id"] == "7" and set(parsed["mlTelemetry"]["featureContrib"]) == {
        "revenueGrowthDelta", "cashFlowRatio", "filingFrequency"}
    assert "created_at" not in parsed and "revenue" in parsed and parsed["revenue"] is None
