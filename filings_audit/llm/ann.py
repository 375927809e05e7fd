"""Approximate nearest neighbours by cosine: inverted lists, and an adaptive scan over dimensions within them.

Vectors are scaled to length 1 and dealt to the list of their nearest centre; a query looks into the lists nearest to
it. All are turned by one random rotation, so that the distance over the first columns tells of the whole. A list is
read in blocks of columns: after each block a test asks whether a candidate whose whole distance was within the k-th
best found so far would show a partial distance as large as this. If that is unlikely the candidate is left; those
that are never left are scored exactly, on their original components in double precision.

The index is fitted on a bounded sample of rows: centres, and how many lists a query must read, which is measured on
that sample. Every row is indexed. Lists are laid side by side and cut into parts of bounded size, so a list of a
third of all rows is many parts, and a query goes once to each part that holds a list of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.llm.common import sample_by_hash
from filings_audit.session import materialize

FIRST, GROUP = 512, 4096  # candidates that set a query's first bar, and those scanned between changes of the bar
SLACK = 1e-5  # of squared distances in single precision


@dataclass(frozen=True)
class Settings:
    """There are about as many lists as the root of the rows, ``lists`` at most. The index is fitted on ``sample`` rows,
    or on ``per_list`` for each list if these are more, but never on more than ``sample_bytes`` of them.

    ``aim`` is the share of the sample's true neighbours whose lists are read. A candidate is left wrongly with a
    chance that falls with ``epsilon``. A part has about ``part_rows`` vectors or queries and ``part_bytes``.
    """

    sample: int = 16_384
    per_list: int = 16
    sample_bytes: int = 64 << 20
    lists: int = 8192
    aim: float = 0.98
    epsilon: float = 2.1
    part_rows: int = 8192
    part_bytes: int = 8 << 20
    rounds: int = 8
    seed: int = 11


def usable(embedding: Column) -> Column:
    """The vector, or null if it or a component is null or not finite, or all components are 0."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine & F.exists(embedding, lambda x: x != 0), embedding)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their largest component, so that squares can't overflow, and the lengths of these."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-320)
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


def rotation(width: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every row, some rows at a time."""
    found = [np.argmax(x[at : at + 1024] @ centres.T, axis=1) for at in range(0, len(x), 1024)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def fit(x: np.ndarray, rows: int, k: int, settings: Settings) -> tuple[np.ndarray, int]:
    """Centres for ``rows`` vectors from a sample of them, and how many lists a query reads."""
    scaled, norms = unit(x)
    x = (scaled / norms[:, None]).astype(np.float32)
    number = max(1, min(settings.lists, int(rows**0.5), len(x)))
    random = np.random.default_rng(settings.seed)
    centres = x[random.permutation(len(x))[:number]]
    for _ in range(settings.rounds):
        own = closest(x, centres)
        order = np.argsort(own, kind="stable")
        used, firsts = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(x[order], firsts, axis=0)
        centres[used] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    own, needed = closest(x, centres), []
    for row in random.permutation(len(x))[:256].tolist():
        near = x @ x[row]
        near[row] = -np.inf
        best = np.argsort(-near, kind="stable")[: min(k, len(x) - 1)]
        place = np.empty(number, np.int64)
        place[np.argsort(-(centres @ x[row]), kind="stable")] = np.arange(number)
        needed.extend(place[own[best]].tolist())
    needed.sort()
    return centres, int(needed[min(len(needed) - 1, int(settings.aim * len(needed)))]) + 1 if len(needed) else 1


def probed(units: np.ndarray, centres: np.ndarray, probes: int, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """The lists that each query reads, nearest first: ``probes`` of them, or more until they hold ``least`` rows."""
    out = []
    for at in range(0, len(units), 256):
        order = np.argsort(-(units[at : at + 256].astype(np.float32) @ centres.T), axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1)
        out.extend(lists[: max(probes, int(np.searchsorted(h, least)) + 1)].copy() for lists, h in zip(order, held))
    return out


def column_blocks(width: int) -> list[tuple[int, int]]:
    """Blocks of 8, 8, 16, 32, 64 ... columns."""
    ends = [0, 8]
    while ends[-1] < width:
        ends.append(2 * ends[-1])
    return [(a, min(b, width)) for a, b in zip(ends, ends[1:])]


def scan(columns: np.ndarray, query: np.ndarray, some: np.ndarray, bar: float, epsilon: float) -> np.ndarray:
    """Those of the candidates ``some`` that no test has left. ``columns``: rotated vectors, a row per dimension."""
    if not np.isfinite(bar):
        return some
    width, partial = len(query), np.zeros(len(some), np.float32)
    for first, end in column_blocks(width):
        apart = columns[first:end, some] - query[first:end, None]
        partial += np.einsum("ij,ij->j", apart, apart)
        limit = bar * (end / width) * (1 + epsilon / end**0.5) ** 2 if end < width else bar
        stay = partial <= limit + SLACK
        some, partial = some[stay], partial[stay]
        if not len(some):
            break
    return some


def search(
    ids: np.ndarray, lists: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, wanted: list[np.ndarray],
    turn: np.ndarray, k: int, epsilon: float,
) -> list[tuple[int, int, float]]:
    """(query id, id, cosine) of the k best of each query among rows of its lists, other than its own id."""
    order = np.lexsort((ids, lists))
    ids, lists, x = ids[order], lists[order], x[order]
    scaled, norms = unit(x)
    columns = np.ascontiguousarray(((scaled / norms[:, None]) @ turn).T.astype(np.float32))
    asked, lengths = unit(queries)
    turned = ((asked / lengths[:, None]) @ turn).astype(np.float32)
    held, firsts, counts = np.unique(lists, return_index=True, return_counts=True)
    at = {name: np.arange(first, first + n) for name, first, n in zip(held.tolist(), firsts.tolist(), counts.tolist())}
    found: list[tuple[int, int, float]] = []
    for row, own in enumerate(query_ids.tolist()):
        scores, names, bar = np.zeros(0), np.zeros(0, np.int64), np.inf
        waiting, n = [], 0
        mine = [at[name] for name in wanted[row].tolist() if name in at]
        for place, members in enumerate(mine):
            waiting.append(members)
            n += len(members)
            if n < (GROUP if np.isfinite(bar) else FIRST) and place + 1 < len(mine):
                continue
            some = np.concatenate(waiting)
            waiting, n = [], 0
            # The first bar comes from a few candidates, so that most of a long list meets one.
            for part in [some] if np.isfinite(bar) else [some[:FIRST], some[FIRST:]]:
                stay = scan(columns, turned[row], part, bar, epsilon)
                stay = stay[ids[stay] != own]
                # Products are summed row by row: equal vectors get equal scores wherever they stand.
                exact = (scaled[stay] * asked[row]).sum(axis=1) / (norms[stay] * lengths[row])
                scores, names = np.concatenate([scores, exact]), np.concatenate([names, ids[stay]])
                best = np.lexsort((names, -scores))[:k]
                scores, names = scores[best], names[best]
                bar = max(0.0, 2 - 2 * scores[-1]) if len(scores) == k else np.inf
        found.extend((own, int(i), float(s)) for i, s in zip(names, scores))
    return found


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Width, rows and vectors of a batch with columns id, width, vector."""
    widths = batch.column(1).to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield width, rows, _matrix(batch.column(2).take(pa.array(rows)), width)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found among ``vectors`` for each row of ``queries``.

    Both have ``id`` (long) and ``vector`` (array of float or double); other columns are not read. Rows with a null in
    either, with a null or non-finite component, or of length 0 take no part. An id is one vector: of rows that share
    an id the smallest vector counts. A query's own id is no candidate, nor are vectors of other widths. Ties go
    by the smaller id. A query gets k rows wherever there are k candidates. Empty tables give no rows.

    The driver receives the sample and one count per list (at most as many as ``lists`` a width), and sends centres, a rotation of
    width * width and these counts; none of them grows with the rows.
    """
    spark = vectors.sparkSession
    parts_of = lambda width: max(64, min(settings.part_rows, settings.part_bytes // (8 * max(1, width))))

    def single(rows: DataFrame) -> DataFrame:
        rows = rows.select("id", usable(F.col("vector")).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
        return rows.groupBy("id").agg(F.min("vector").alias("vector")).select("id", F.size("vector").alias("width"), "vector")

    base = materialize(single(vectors), "vectors")
    counts = {row["width"]: row["count"] for row in base.groupBy("width").count().collect()}
    lists = min(settings.lists, int(sum(counts.values()) ** 0.5))
    most = min(max(settings.sample, settings.per_list * lists), settings.sample_bytes // (8 * max(counts, default=1)))
    sample = sample_by_hash(base, "id", max(64, most)).toArrow()
    turns, models = {}, {}
    seen = {width: (rows, x) for batch in sample.combine_chunks().to_batches() for width, rows, x in _by_width(batch)}
    for width, rows in counts.items():
        turns[width] = rotation(width, settings.seed)
        # A width that the sample lacks is one list, which every query of that width reads.
        models[width] = fit(seen[width][1], rows, k, settings) if width in seen else (np.ones((1, width), np.float32), 1)
    shared = spark.sparkContext.broadcast(models)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros(batch.num_rows, np.int32)
            for width, rows, x in _by_width(batch):
                scaled, norms = unit(x)
                own[rows] = closest((scaled / norms[:, None]).astype(np.float32), shared.value[width][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=["id", "width", "vector", "list"])

    kind = base.schema["vector"].dataType.simpleString()
    base = materialize(base.mapInArrow(assign, f"id long, width int, vector {kind}, list int"), "lists")
    sizes = {width: np.zeros(len(models[width][0]), np.int64) for width in models}
    for width, name, n in base.groupBy("width", "list").count().collect():
        sizes[width][name] = n
    layout = {}
    for width, held in sizes.items():
        before = np.cumsum(held) - held
        first = before // parts_of(width)
        layout[width] = first, np.maximum(before + held - 1, before) // parts_of(width) - first + 1
    plain = {w: (*models[w], sizes[w], *layout[w], turns[w]) for w in models}
    known = spark.sparkContext.broadcast(plain)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts that hold lists of each query."""
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for width, rows, x in _by_width(batch):
                if width not in known.value:
                    continue
                centres, probes, held, first, n, _ = known.value[width]
                scaled, norms = unit(x)
                for row, lists in zip(rows, probed(scaled / norms[:, None], centres, probes, held, k + 1)):
                    lists = lists[held[lists] > 0]
                    spans = [np.arange(a, a + m) for a, m in zip(first[lists], n[lists])]
                    out[row] = np.unique(np.concatenate(spans)).tolist() if spans else []
            made = pa.array(out, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=["id", "width", "vector", "parts"])

    own = single(queries)
    asked_kind = own.schema["vector"].dataType.simpleString()
    asked = own.mapInArrow(parts, f"id long, width int, vector {asked_kind}, parts array<long>")
    asked = materialize(asked.select("id", "width", "vector", F.explode("parts").alias("part")), "queries")
    # Parts that many queries ask are met by several blocks of queries.
    block = F.greatest(F.lit(64), F.least(F.lit(settings.part_rows), F.floor(F.lit(settings.part_bytes) / (8 * F.col("width")))))
    load = asked.groupBy("width", "part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = [(w, i, int(a), int(m)) for w, (first, n) in layout.items() for i, (a, m) in enumerate(zip(first, n))]
    places = F.broadcast(spark.createDataFrame(rows, "width int, list int, first long, n long"))  # a row per list
    dealt = base.join(places, ["width", "list"]).withColumn("part", F.col("first") + F.pmod(F.xxhash64("id"), F.col("n")))
    left = dealt.join(load, ["width", "part"]).select("width", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"), "id", "list", "vector")
    right = asked.join(load, ["width", "part"]).select("width", "part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("q"), "id", "vector")
    epsilon = settings.epsilon

    def meet(have: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if have.num_rows and ask.num_rows:
            width = have["width"][0].as_py()
            centres, probes, held, _, _, turn = known.value[width]
            queries = _matrix(ask["vector"], width)
            scaled, norms = unit(queries)
            wanted = probed(scaled / norms[:, None], centres, probes, held, k + 1)
            out = search(
                have["id"].to_numpy(), have["list"].to_numpy(), _matrix(have["vector"], width), ask["id"].to_numpy(), queries,
                wanted, turn, k, epsilon,
            )
        ids, names, scores = zip(*out) if out else ([], [], [])
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(names, pa.int64()), "score": pa.array(scores, pa.float64())})

    keys = ["width", "part", "q"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
