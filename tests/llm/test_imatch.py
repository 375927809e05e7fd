import hashlib
import random

import pytest
from pyspark.sql import functions as F

from filings_audit.llm import imatch
from filings_audit.llm.queries import op3_imatch

SCHEMA = "doc_id long, text string, lang string, n_chars long, part int, word string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, 1, "x") for i, t in rows], SCHEMA)


def edited_by_hand(rows):
    """doc_id -> (n_chars, digest of the edited text); of equal ids in the order of their texts."""
    ordered = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    texts = [t or "" for _, t in ordered]
    out = []
    for k, (i, _) in enumerate(ordered):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def made_up(n, seed=3):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(2, 7))) for _ in range(400)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("rows_per_part", [1, 7, 1000])
def test_edited_texts_against_a_plain_loop(spark, rows_per_part):
    texts = made_up(60)
    rows = [(7 * i - 90, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "🙂é"), (1003, "x"), (None, "no id")]
    rows += [rows[5], (rows[6][0], "another text with an id that is there")]
    found = imatch.fingerprints(frame(spark, rows), imatch.Band(rows_per_part=rows_per_part)).collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited) for r in found], key=str) == edited_by_hand(rows)


def test_fingerprints_do_not_depend_on_the_parts(spark):
    rows = list(enumerate(made_up(80)))
    results = []
    for size in (3, 1000):
        found = imatch.fingerprints(frame(spark, rows).repartition(size % 7), imatch.Band(rows_per_part=size))
        results.append({r.doc_id: r for r in found.collect()})
    assert results[0] == results[1]
    for i, row in results[0].items():
        assert row.next_hashes == results[0][i - 1 if i else 79].hashes


def test_lexicon_is_the_band(spark):
    rows = [(i, f"all {'half' if i % 2 else ''} only{i} only{i}") for i in range(20)]
    band = imatch.Band(lowest=0.1, highest=0.6)
    assert [r.word for r in imatch.lexicon(frame(spark, rows), 20, band).collect()] == ["half"]


def test_equal_texts_near_texts_and_other_texts(spark):
    texts = made_up(300, seed=5)
    texts = [t for t in texts if len(t) > 200]
    near = texts[0] + " unseenword"
    rows = list(enumerate([*texts, texts[0], near, "", None]))
    found = {r.doc_id: r for r in imatch.fingerprints(frame(spark, rows), imatch.Band(lowest=0.01, highest=0.5)).collect()}
    n = len(texts)
    assert found[0].hashes == found[n].hashes == found[n + 1].hashes
    assert found[n + 2].hashes == found[n + 3].hashes
    assert len({tuple(found[i].hashes) for i in range(n)}) == n


def test_texts_without_lexicon_words_keep_apart(spark):
    rows = list(enumerate(["one", "two", "three", "one"]))
    found = {r.doc_id: r.hashes for r in imatch.fingerprints(frame(spark, rows), imatch.Band(lowest=0.9, highest=1)).collect()}
    assert found[0] == found[3] and len({tuple(h) for h in found.values()}) == 3


def test_empty_table(spark):
    assert imatch.fingerprints(frame(spark, [])).collect() == []


def test_query_is_native_and_complete(spark, sf_dir):
    found = op3_imatch(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian") if n in plan]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found.collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == edited_by_hand(rows)
    text, prints = dict(rows), {r.doc_id: r.fingerprint for r in got}
    by_text = {}
    for i, t in text.items():
        assert by_text.setdefault(t, prints[i]) == prints[i]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert found.where(F.col("near_next") > 0.5).count() < len(rows) / 10
