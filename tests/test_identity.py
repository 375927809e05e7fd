import hashlib
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filings_audit.functions import identity


def test_salted_hash_golden(spark):
    rows = spark.createDataFrame([("Dana Quill",), ("Omar Vale",), (None,)], "name string").select(
        "name",
        identity.salted_sha256(F.col("name"), "gdpr-salt-v1").alias("v1"),
        identity.salted_sha256(F.col("name"), "salt-v2").alias("v2"),
    )
    found = {r.name: (r.v1, r.v2) for r in rows.collect()}
    assert found["Dana Quill"] == (
        "cdce68b67c36c80e19b749e1d1e96c27dde685e87562fc69365273d1b9a3f62b",
        "406dc4e5d3d00e82cc9d12a35fcffdcfa266867f81ff52df8c2ab52c6e2d6a59",
    )
    assert found["Omar Vale"][0] == "5d8ff749731e74487642abec1c66957ef2a05c471a9b341cccdb4bed126559f4"
    assert found[None] == (None, None)


@pytest.mark.parametrize("cik,day,form,expected", [
    ("320193", "2024-01-15", "10-K", "6926b648-27bf-5539-9ff9-a2797242904c"),
    ("320193", "2024-01-15", "8-K", "2c979787-df7f-54ad-b756-2ddf69054dcd"),
    ("7", "1900-01-01", "8-K", "7a8847ee-bf4d-572c-ab07-d76e9e367db1"),
])
def test_filing_uuid_golden(one, cik, day, form, expected):
    row = one((cik, day, form), "c string, d string, f string",
              id=identity.filing_uuid(F.col("c"), F.col("d").cast("date"), F.col("f")))
    assert row["id"] == expected


def test_filing_uuid_missing_part_reads_none(one):
    row = one(("1", None), "c string, f string",
              id=identity.filing_uuid(F.col("c"), F.lit("2024-01-01").cast("date"), F.col("f")))
    assert row["id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "1:2024-01-01:None"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=20, max_size=40))
def test_matches_python_for_any_text(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select(
        "t", identity.uuid5_url(F.col("t")).alias("u"),
        *[identity.md5_mod(F.col("t"), m).alias(f"m{m}") for m in (3, 5, 1000, 10000)],
    ).collect()
    for row in rows:
        number = int(hashlib.md5(row.t.encode()).hexdigest(), 16)
        assert row.u == str(uuid.uuid5(uuid.NAMESPACE_URL, row.t))
        assert [row.m3, row.m5, row.m1000, row.m10000] == [number % m for m in (3, 5, 1000, 10000)]
