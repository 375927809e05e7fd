import random
import re

import numpy as np
import pytest

from filings_audit.llm import neardup
from filings_audit.llm.components import components
from filings_audit.llm.queries import op1_minhash


def shingle_set(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def by_hand(rows, size=3, percent=85):
    """(doc_id, set size, smallest id of the component), comparing all pairs of sets that share a shingle."""
    ids, sets = [i for i, _ in rows], [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for x, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(x)
    common = {}
    for members in holders.values():
        for a in range(len(members)):
            for b in range(a):
                pair = members[b], members[a]
                common[pair] = common.get(pair, 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for x in range(len(rows)):
        if ids[x] is not None:
            least[root(x)] = min(least.get(root(x), ids[x]), ids[x])
    return sorted((ids[x], len(sets[x]), least.get(root(x)) if ids[x] is not None else None) for x in range(len(rows)))


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, sketch string, u int")
    result = neardup.near_duplicates(docs.repartition(3), neardup.Settings(**{"words": 3, "percent": 85} | settings))
    return sorted(tuple(r) for r in result.collect())


def made_up(seed=1, n=40, copies=12):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 30, 150, 400]))]
        if r.random() < 0.5:
            base = passage + base
        texts.append(" ".join(base))
        for _ in range(r.randint(0, copies)):
            near = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                near[r.randrange(len(near))] = r.choice(vocabulary)
            texts.append(" ".join(near))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 8])
def test_components_against_all_pairs(spark, block):
    texts = made_up() + ["", None, " \t", "one", "ONE", "one two", "one two", "Ä b", "ä b", "x" * 100_000, "a b c " * 20_000]
    rows = [(3 * i + 7, t) for i, t in enumerate(texts)]
    assert found(spark, rows, block=block) == by_hand(rows)


def test_large_lists_and_groups(spark, monkeypatch):
    r = random.Random(5)
    base = [f"w{r.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(400):
        near = list(base)
        for _ in range(r.randint(0, 9)):
            near[r.randrange(len(near))] = f"v{r.randrange(900)}"
        rows.append((i, " ".join(near)))
    rows += [(1000 + i, " ".join(base[:60] + [f"u{r.randrange(5000)}" for _ in range(100)])) for i in range(200)]
    wanted = by_hand(rows)
    assert found(spark, rows) == wanted == found(spark, rows, block=64)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (9, text + " x"), (2, "other words here"), (2, "other words here")]
    assert found(spark, rows) == by_hand(rows)
    docs = spark.createDataFrame([(None, text), (7, text)], "doc_id long, text string")
    got = {tuple(r) for r in neardup.near_duplicates(docs).collect()}
    assert got == {(None, 46, None), (7, 46, 7)}  # five words by default


def test_different_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    rows = [(3, a), (5, a + " x"), (5, b), (5, c), (8, c + " x"), (9, b)]
    assert found(spark, rows) == by_hand(rows)
    assert {r[2] for r in found(spark, rows) if r[0] in (5, 8, 9)} == {3, 5}


def test_empty_table(spark):
    assert found(spark, []) == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 99) for i in range(30)] + [(500, 500), (0, 0), (7, 3)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 99 for i in range(99, 130)} | {500: 500}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_estimates_of_whole_and_cut_sketches():
    r = np.random.default_rng(1)
    values = r.integers(0, 2**62, 2000, dtype=np.uint64)
    a, b = np.unique(values[:1800]), np.unique(values[200:])
    sketch = np.stack([(x[:64] >> np.uint64(32)).astype(np.uint32) for x in (a, b)])
    assert abs(neardup._estimates(sketch, np.array([0]), np.array([1]), 64)[0] - 0.8) < 0.25


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op1_minhash(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_hand(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_defaults_are_five_words_and_80_percent(spark):
    """A block of new text in a copy: between 0.80 and 0.85 by five words, and just below 0.80."""
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*base[:200], *[f"new{i}x{j}" for j in range(n)], *base[200:]])) for i, n in ((2, 80), (3, 90), (4, 105))]
    rows += [(1, " ".join(base)), (9, "unlike " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs).collect())
    assert got == by_hand(rows, 5, 80) and [c for *_, c in got] == [1, 1, 1, 4, 9]


def test_cells_of_a_long_list_hold_every_pair_of_similar_size_and_few_rows(spark):
    """One list of sets of 1 to 4,000 shingles; sizes at the threshold must meet, others need not."""
    r = random.Random(7)
    sizes = [r.randint(1, 4000) for _ in range(3000)] + [80, 100, 64, 125, 1, 1]
    rows = spark.createDataFrame([(1, i, n) for i, n in enumerate(sizes)] + [(2, 0, 5), (3, 1, 5), (3, 2, 5000)],
                                 "key long, vertex long, n_shingles long")
    settings = neardup.Settings(block=100)
    cells = {}
    for key, cell, vertex in neardup._cells(rows, "key", settings).collect():
        cells.setdefault((key, cell), set()).add(vertex)
    assert {k for k, _ in cells} == {1, 3}
    met = np.zeros((len(sizes), len(sizes)), bool)
    for (key, _), members in cells.items():
        if key == 1:
            some = np.array(sorted(members))
            met[np.ix_(some, some)] = True
    n = np.array(sizes)
    alike = 100 * np.minimum.outer(n, n) >= 80 * np.maximum.outer(n, n)
    np.fill_diagonal(alike, False)
    assert not (alike & ~met).any()
    # Blocks of the whole list would take 31 rows for each of its 3,006 members.
    assert sum(map(len, cells.values())) < 16 * len(sizes)


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_bands_keep_pairs_at_the_threshold(percent):
    band = neardup.Settings(percent=percent).band
    for larger in range(1, 3000):
        smaller = -(-percent * larger // 100)
        assert abs(int(np.log(larger) // band) - int(np.log(smaller) // band)) <= 1
