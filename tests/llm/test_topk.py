import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filings_audit.llm import topk


def by_hand(vectors, queries, k):
    """vectors, queries: id -> list of whole numbers."""
    out = []
    for qid, q in queries.items():
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors.items() if i != qid and len(v) == len(q)]
        out.extend((qid, rank + 1, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k]))
    return sorted(out)


def run(spark, vectors, queries, k=5):
    frame = lambda rows: spark.createDataFrame(rows, "id long, vector array<long>")
    return sorted(tuple(r) for r in topk.top_k(frame(vectors), frame(queries), k).collect())


@pytest.mark.parametrize("n,width,k", [(700, 16, 5), (300, 3, 4), (3, 8, 5), (1, 4, 2)])
def test_against_all_products(spark, monkeypatch, n, width, k):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 150)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 8)
    r = random.Random(n)
    vectors = {7 * i: [r.randint(-128, 128) for _ in range(width)] for i in range(n)}
    queries = {i: v for i, v in vectors.items() if i % 5 == 0}
    assert run(spark, list(vectors.items()), list(queries.items()), k) == by_hand(vectors, queries, k)


def test_ties_of_a_third_of_all_vectors(spark):
    vectors = {i: [5, 5, 0] if i % 3 else [i % 7, 1, 2] for i in range(600)}
    queries = {i: vectors[i] for i in range(0, 600, 50)}
    assert run(spark, list(vectors.items()), list(queries.items())) == by_hand(vectors, queries, 5)


def test_large_components_stay_exact(spark):
    vectors = {i: [2**28 + i, -(2**27) * i, 1] for i in range(20)}
    assert run(spark, list(vectors.items()), [(3, vectors[3])]) == by_hand(vectors, {3: vectors[3]}, 5)


def test_one_large_component_among_small_ones(spark):
    r = random.Random(5)
    vectors = {i: [r.randint(-128, 128) for _ in range(6)] for i in range(400)}
    vectors[400] = [-(2**55), 256, 0, 0, 0, 1]
    vectors[401] = [2**55 + 1, 256, 0, 0, 0, 1]
    vectors[402] = [-(2**55), 256, 0, 0, 0, 2]
    queries = {i: vectors[i] for i in range(0, 400, 20)}
    assert run(spark, list(vectors.items()), list(queries.items())) == by_hand(vectors, queries, 5)


def test_the_lowest_long(spark):
    vectors = {1: [-(2**63), 1], 2: [3, 4], 3: [-(2**63), 2], 4: [2**63 - 1, 0]}
    queries = {9: [0, 1], 8: [-1, 0]}
    two = {i: v for i, v in vectors.items() if i in (2, 4)}
    assert run(spark, list(vectors.items()), [(9, [0, 1])]) == by_hand(vectors, {9: [0, 1]}, 5)
    assert run(spark, list(two.items()), list(queries.items())) == by_hand(two, queries, 5)
    with pytest.raises(Exception, match="(?i)int|long|overflow"):
        run(spark, list(vectors.items()), [(8, [-1, 0])])


def test_bounds_of_large_components_leave_few(monkeypatch):
    r = np.random.default_rng(2)
    x, queries = (r.integers(-(2**28), 2**28, (n, 8)) for n in (3000, 5))
    seen, exact = [], topk._products
    monkeypatch.setattr(topk, "_products", lambda some, q, large: seen.append((len(some), large)) or exact(some, q, large))
    asked = {-1 - i: q for i, q in enumerate(queries.tolist())}
    found = topk.best(np.arange(3000), x, np.array(list(asked)), queries, 5)
    order = {(q, i): rank for q, rank, i, _ in by_hand(dict(enumerate(x.tolist())), asked, 5)}
    assert sorted((q, order[q, i], i, score) for q, i, score in found) == by_hand(dict(enumerate(x.tolist())), asked, 5)
    assert len(seen) == 5 and all(n <= 40 and large for n, large in seen)


def test_repeated_ids_other_lengths_and_nulls(spark):
    rows = [(1, [1, 1]), (1, [1, 1]), (2, [3, 0]), (2, [1, 0]), (3, [9]), (None, [9, 9]), (4, None), (5, []), (6, [])]
    vectors = {1: [1, 1], 2: [1, 0], 3: [9], 5: [], 6: []}
    assert run(spark, rows, rows) == by_hand(vectors, vectors, 5)
    assert run(spark, [], []) == [] == run(spark, [(1, [1])], [])


def test_quantised(spark):
    rows = [([0.5, -0.501],), ([None, 1.0],), ([float("nan")],), ([float("inf")],), (None,), ([],)]
    frame = spark.createDataFrame(rows, "e array<float>").select(topk.quantised(F.col("e")).alias("v"))
    assert [r.v for r in frame.collect()] == [[128, -129], None, None, None, None, []]


def test_reading_stops_early():
    r = np.random.default_rng(1)
    x = r.integers(-3, 4, (4000, 4))
    x[17] = 100
    found = topk.best(np.arange(4000), x, np.array([-1]), np.array([[1, 1, 1, 1]]), 1)
    assert found == [(-1, 17, 400)]
