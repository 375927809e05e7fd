"""Exact top-k by inner product, without random access.

For each dimension a block of vectors has a list sorted by that component. The lists are read in step from the end that a
query's sign favours. What has been read gives each vector a lower bound (unread components count as the worst of
their list) and an upper bound (they count as the last value read). Reading stops for a query once few vectors remain
whose upper bound reaches the k-th best lower bound; their scores are then resolved. Bounds of many queries are two
matrix products. Where components are so large that these would round, each bound is widened by the most that it can
have been rounded, and scores are resolved in whole numbers of any size: results are exact for all longs.

Vectors and queries are dealt into blocks, and every block of queries meets every block of vectors once, in a task
of bounded size. Only k rows per query leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.session import materialize

BLOCK_VECTORS, BLOCK_QUERIES, TOGETHER = 8192, 8192, 128


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null if the vector or a component is null or not finite."""
    values = F.transform(embedding, lambda x: x.cast("double"))
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(values, lambda x: F.floor(x * scale)))


def _bounds(lists: np.ndarray, order: np.ndarray, depth: int, x_shape: tuple, rest: np.ndarray):
    """A table of what is known after reading ``depth`` entries of each list: for upper and for lower bounds."""
    upper = np.broadcast_to(lists[depth - 1], x_shape).copy()
    lower = np.broadcast_to(rest, x_shape).copy()
    columns = np.arange(x_shape[1])
    upper[order[:depth], columns] = lists[:depth]
    lower[order[:depth], columns] = lists[:depth]
    return upper, lower


def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best vectors other than the query's own id, ties by the smaller id."""
    n, width = x.shape
    largest = _largest(x) * _largest(queries) * max(1, width)
    rounds = largest >= 2**53
    kind = np.float32 if largest < 2**24 else np.float64  # sums stay exact
    order = np.argsort(x, axis=0, kind="stable")
    rising = np.take_along_axis(x, order, axis=0).astype(kind)
    falling, order_down = rising[::-1], order[::-1]
    depths = sorted({max(1, n // 8), max(1, n // 4), max(1, n // 2), n}) if n else []
    found: list[tuple[int, int, int]] = []
    tables = {}
    for at in range(0, len(query_ids), TOGETHER):
        waiting = np.arange(at, min(at + TOGETHER, len(query_ids)))
        for depth in depths:
            if depth not in tables:
                tables[depth] = *_bounds(falling, order_down, depth, x.shape, rising[0]), *_bounds(rising, order, depth, x.shape, falling[0])
            up_high, up_low, down_high, down_low = tables[depth]
            q = queries[waiting].astype(kind)
            plus, minus = np.maximum(q, 0).T, np.minimum(q, 0).T
            upper, lower = up_high @ plus + down_high @ minus, up_low @ plus + down_low @ minus
            if rounds:
                upper += _rounding(up_high, down_high, plus, minus)
                lower -= _rounding(up_low, down_low, plus, minus)
            own = ids[:, None] == query_ids[waiting][None, :]
            upper[own] = lower[own] = -np.inf
            place = max(0, n - k)
            bar = np.partition(lower, place, axis=0)[place] if n else np.zeros(len(waiting))
            open_to = (upper >= bar) & ~own
            done = (open_to.sum(axis=0) <= 8 * k) | (depth == n)
            for column in np.flatnonzero(done):
                some = np.flatnonzero(open_to[:, column])
                scores = _products(x[some], queries[waiting[column]], rounds)
                chosen = np.lexsort((ids[some], -scores))[:k]
                found.extend((int(query_ids[waiting[column]]), int(ids[some[c]]), int(scores[c])) for c in chosen)
            waiting = waiting[~done]
            if not len(waiting):
                break
    return found


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def _rounding(high: np.ndarray, low: np.ndarray, plus: np.ndarray, minus: np.ndarray) -> np.ndarray:
    """The most that ``high @ plus + low @ minus`` can be off: a rounding per factor, product and sum, on the sum of absolute
    values. Twice the usual bound, which pays for the roundings of this sum itself."""
    size = np.abs(high) @ plus - np.abs(low) @ minus
    return size * ((high.shape[1] + 4) * 2.0**-51)


def _products(x: np.ndarray, query: np.ndarray, large: bool) -> np.ndarray:
    """Exact scores, large ones as Python integers."""
    return x.astype(object) @ query.astype(object) if large else x @ query


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows of ``vectors`` for each row of ``queries``.

    Both have ``id`` (long) and ``vector`` (array of long); nulls in either take no part. An id is one vector: of rows that
    share an id the smallest vector counts. A query's own id is no candidate. Vectors of other lengths
    than the query's are none either. Fewer candidates give fewer rows. A score among the best that doesn't fit a long ends the
    job with an error.
    """

    def dealt(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
        one = rows.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
        one = materialize(one.withColumn("width", F.size("vector")), "vectors")
        blocks = max(1, -(-one.count() // size))
        return one.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), blocks

    base, base_blocks = dealt(vectors, BLOCK_VECTORS)
    asked, asked_blocks = dealt(queries, BLOCK_QUERIES)
    left = base.select("width", F.col("block").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))).alias("q"), "id", "vector")
    right = asked.select("width", F.explode(F.sequence(F.lit(0), F.lit(base_blocks - 1))).alias("b"), F.col("block").alias("q"), "id", "vector")

    def meet(found: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if found.num_rows and wanted.num_rows:
            width = found["width"][0].as_py()
            x, queries = (
                t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, width) for t in (found, wanted)
            )
            out = best(found["id"].to_numpy(), x, wanted["id"].to_numpy(), queries, k)
        columns = zip(*out) if out else ([], [], [])
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    keys = ["width", "b", "q"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
