import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from filings_audit.llm import resample
from filings_audit.llm.resample import Settings, crc32s

SCHEMA = "doc_id long, text string, weight string, rank string, score string"


def by_hand(docs, target, s: Settings):
    """docs: (doc_id, text) rows; the contract in plain loops."""

    def features(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + n]) for n in range(1, s.longest + 1) for i in range(len(words) - n + 1)]
        return words, [zlib.crc32(run.encode()) % s.buckets for run in runs]

    source, wanted = [0] * s.buckets, [0] * s.buckets
    for texts, counts in (([t for _, t in docs], source), (target, wanted)):
        for text in texts:
            for bucket in features(text)[1]:
                counts[bucket] += 1
    size_s, size_t = float(sum(source) + s.buckets), float(sum(wanted) + s.buckets)
    gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * size_s / ((source[b] + 1.0) * size_t))) for b in range(s.buckets)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words), len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= s.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * s.percent // 100]):
        row[5] = place + 1
    return sorted(map(tuple, rows), key=str)


def run(spark, docs, target, s=Settings()):
    frame = spark.createDataFrame([(i, t, "x", "y", None) for i, t in docs], SCHEMA)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resample.resample(frame, wanted, s).collect()), key=str)


def corpus(n):
    r = random.Random(5)
    words = ["Alpha", "beta", "straße", "ÉTÉ", "42nd", "x", "omega" * 30, "日本語", "it's", "a\x00b", "C3PO_z"]
    return [(7 * i, " ".join(r.choice(words) for _ in range(r.randint(0, 60))) + r.choice(["", ".\n", "\x7f"])) for i in range(n)]


@pytest.mark.parametrize("s", [Settings(), Settings(longest=3, buckets=97, percent=33, least_words=5)])
def test_against_plain_loops(spark, s):
    docs, target = corpus(120), [t for _, t in corpus(15)]
    assert run(spark, docs, target, s) == by_hand(docs, target, s)


def test_nulls_repeats_ties_and_empty_tables(spark):
    s = Settings(least_words=1, percent=50)
    docs = [(3, None), (3, ""), (None, "beta beta"), (4, "same words"), (4, "same words"), (4, "same words"), (5, "?!"), (None, None)]
    assert run(spark, docs, ["beta", None], s) == by_hand(docs, ["beta", None], s)
    assert run(spark, docs, [], s) == by_hand(docs, [], s)
    assert run(spark, [], ["beta"], s) == []


def test_a_third_of_all_rows_is_one(spark):
    docs = [(9, "alpha beta gamma") if i % 3 == 0 else (i, f"alpha {i}") for i in range(300)]
    s = Settings(least_words=2, percent=40)
    assert run(spark, docs, ["alpha"], s) == by_hand(docs, ["alpha"], s)


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(resample, "SLICE", 64)
    docs, s = corpus(60), Settings(longest=3, least_words=5, percent=30)
    assert run(spark, docs, ["beta x x"], s) == by_hand(docs, ["beta x x"], s)


def test_crc_of_all_lengths():
    r = np.random.default_rng(1)
    features = [r.integers(0, 256, n, dtype=np.uint8).tobytes() for n in [*range(0, 600), 4096, 100_001] for _ in range(2)]
    assert crc32s(features).tolist() == [zlib.crc32(f) for f in features]
    assert crc32s([]).tolist() == []
