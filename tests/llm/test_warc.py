import base64
import hashlib

import pytest

from filings_audit.llm import warc
from filings_audit.llm.queries import op8_warc
from filings_audit.session import new_dir

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {n}\r\n\r\nfalse\r\n\r\n"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def by_hand(rows, min_bytes=0):
    """page_id -> payload size, digest, type, refers_to."""
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        size, first = len((html or "").encode()), largest[html or ""]
        again = size >= min_bytes and first != i
        out.append((i, size, digest(html), "revisit" if again else "response", first if again else None))
    return sorted(out)


def page(name):
    return int(name.removeprefix("<urn:page:").removesuffix(">")) if name else None


def round_trip(spark, rows, min_bytes=0, parts=2, split=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    path = new_dir(spark, "warc-test")
    warc.write(pages, path, min_bytes)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        found = warc.read(spark, path, payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for r in found:
        if r.type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest
    return sorted((page(r.record_id), r.payload_bytes, r.payload_digest, r.type, page(r.refers_to)) for r in found)


def made_up():
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>\r\n" * (i % 50)) for i in range(300)]
    rows += [(1000 + i, None, "same page ü") for i in range(40)]
    rows += [(2000, "x\r\ny", None), (2001, "", ""), (2002, None, "\r\n\r\n")]
    rows += [(3000 + i, "u", f"start {i} " + FAKE.format(n=n) + "end" * i) for i, n in enumerate([0, 5, 7, 10**9, 5000])]
    rows += [(4000, "u", "WARC/1.1\r\n" * 50), (4001, "u", "WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 12\r\n\r\n")]
    rows += [(5000, "u", ("filler " * 30 + FAKE.format(n=5)) * 40)]
    return rows


@pytest.mark.parametrize("parts,split", [(1, None), (3, None), (1, 700), (2, 2000), (1, 5000)])
def test_round_trip_rejects_magic_inside_payloads(spark, parts, split):
    rows = made_up()
    assert round_trip(spark, rows, 0, parts, split) == by_hand(rows)


def test_small_payloads_are_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    assert round_trip(spark, rows, min_bytes=5) == by_hand(rows, 5)


def test_null_ids_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(None, "u", "a"), (5, "u", "a"), (5, "u", "a"), (None, None, None)], "page_id long, url string, html string")
    path = new_dir(spark, "warc-test")
    warc.write(pages, path)
    found = sorted((r.record_id, r.type, r.refers_to) for r in warc.read(spark, path).collect())
    assert found == [
        ("<urn:page:5>", "response", None), ("<urn:page:5>", "response", None),
        ("<urn:page:null>", "response", None), ("<urn:page:null>", "revisit", "<urn:page:5>"),
    ]
    assert round_trip(spark, []) == []


def test_a_file_that_ends_inside_a_record(spark, tmp_path):
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.txt").write_bytes(whole * 2 + whole[:-6])
    (tmp_path / "b.txt").write_bytes(b"no archive" + whole)
    assert [r.offset for r in warc.read(spark, str(tmp_path)).orderBy("offset").collect()] == [0, len(whole)]


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    found = op8_warc(spark, sf_dir).collect()
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    assert got == by_hand(rows)
