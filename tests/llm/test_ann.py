import numpy as np
import pytest
from pyspark.sql import functions as F

from filings_audit.llm import ann
from filings_audit.llm.ann import Settings

SCHEMA = "id long, vector array<double>, rank string, part string"


def by_hand(vectors, queries, k):
    """vectors, queries: id -> vector. All candidates of equal width, exactly."""
    out = {}
    for qid, q in queries.items():
        q = np.array(q, float)
        scored = []
        for i, v in vectors.items():
            if i != qid and len(v) == len(q):
                v = np.array(v, float)
                a, b = q / np.abs(q).max(), v / np.abs(v).max()
                scored.append((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i))
        out[qid] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def run(spark, vectors, queries, k=5, s=Settings()):
    frame = lambda rows: spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    out = {}
    for r in sorted(ann.nearest(frame(vectors), frame(queries), k, s).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(found, true):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in rows}) for q, rows in true.items())
    return hits / max(1, sum(map(len, true.values())))


@pytest.mark.parametrize("clusters", [None, 12])
def test_recall_against_brute_force(spark, clusters):
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 48))
    if clusters:
        x = r.normal(size=(clusters, 48))[r.integers(0, clusters, 3000)] + 0.4 * x
    vectors = {3 * i: v.tolist() for i, v in enumerate(x)}
    queries = {i: v for i, v in vectors.items() if i % 50 == 0}
    found = run(spark, list(vectors.items()), list(queries.items()), s=Settings(part_rows=400, sample=1000))
    true = by_hand(vectors, queries, 5)
    assert recall(found, true) >= 0.9
    exact = {q: by_hand({i: vectors[i] for i, _ in rows}, {q: queries[q]}, 5)[q] for q, rows in found.items()}
    for q, rows in found.items():  # full, in order, and scored on the original vectors
        assert [i for i, _ in rows] == [i for i, _ in exact[q]] and len(rows) == 5
        assert np.allclose([s for _, s in rows], [s for _, s in exact[q]], rtol=0, atol=1e-12)


def test_a_third_of_all_vectors_is_one(spark):
    r = np.random.default_rng(4)
    vectors = {i: [0.5, -0.25, 0.125, 1.0] if i % 3 == 0 else r.normal(size=4).tolist() for i in range(900)}
    queries = {i: vectors[i] for i in range(0, 900, 50)}
    found = run(spark, list(vectors.items()), list(queries.items()), s=Settings(part_rows=64))
    for q in range(0, 900, 150):  # copies of one vector: the smallest ids other than its own
        assert [i for i, _ in found[q]] == [i for i in range(0, 24, 3) if i != q][:5]
    assert recall(found, by_hand(vectors, queries, 5)) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0]), (2, [1.0, 0.5]), (3, [9.0]), (None, [9.0, 9.0]), (4, None), (5, []),
            (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1e300, -1e300]), (11, [1e-300, 0.0])]
    vectors = {1: [1, 1], 2: [1, 0.5], 3: [9], 10: [1e300, -1e300], 11: [1e-300, 0]}
    found = run(spark, rows, rows)
    true = by_hand(vectors, vectors, 5)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in true.items() if v}
    assert run(spark, [], []) == {} == run(spark, [(1, [1.0])], [])
    assert run(spark, [], [(1, [1.0])]) == {}


def test_queries_with_few_near_rows_still_get_k(spark):
    r = np.random.default_rng(5)
    near = r.normal(size=(300, 8)) * 0.01 + 1
    vectors = {i: v.tolist() for i, v in enumerate(near)} | {1000: (-np.ones(8)).tolist()}
    found = run(spark, list(vectors.items()), [(1000, vectors[1000])])
    assert len(found[1000]) == 5


def test_tests_leave_most_candidates_and_no_near_one():
    r = np.random.default_rng(6)
    x = r.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    query = x[0] + 0.02 * r.normal(size=64)
    query /= np.linalg.norm(query)
    turn = ann.rotation(64, 1)
    assert np.allclose(turn @ turn.T, np.eye(64))
    apart = ((x - query) ** 2).sum(axis=1)
    bar = float(np.sort(apart)[4])
    stay = ann.scan(np.ascontiguousarray((x @ turn).T.astype(np.float32)), (query @ turn).astype(np.float32), np.arange(20_000), bar, 2.1)
    assert len(stay) < 20 and set(np.flatnonzero(apart <= bar)) <= set(stay.tolist())


def test_sample_never_becomes_empty(spark):
    from filings_audit.llm.common import sample_by_hash

    rows = spark.range(50_000).select(F.col("id"))
    assert 300 < sample_by_hash(rows, "id", 500).count() < 700 and sample_by_hash(rows, "id", 50_000).count() == 50_000
