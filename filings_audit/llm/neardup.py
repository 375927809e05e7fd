"""Near-duplicate documents by bottom-k sketches and exact Jaccard similarity.

1. Every document becomes the set of the hashes of its word shingles. Documents with equal sets are one class from here on.
2. The sketch of a set is its k smallest hashes, all from one hash function. The first few of them are keys of inverted
   lists. Linked sets share a share t of their union, so all of the first m values of the union would have to fall into
   the rest for two linked sets to meet in no list: (1 - t)^m, 1e-7 for the defaults.
3. Within a list the union of two sketches, cut to its k smallest values, estimates the similarity. Pairs whose estimate is
   further below the threshold than sampling explains (five standard deviations) are not looked at again. Of the
   rest a task emits a spanning forest only, so a list never emits more edges than it has members.
4. The components of these edges are groups of candidates. The full sets of a group meet in a task, which counts all
   intersections exactly and emits a spanning forest of the links. Their components are the result.

Linked sets are of similar size, so a list or a group too large for a task is dealt into bands of set sizes as wide as the
threshold allows, and only neighbouring bands meet. What is still too large is cut into blocks, and every pair of
blocks meets in a task of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filings_audit.llm.common import lean, map_texts
from filings_audit.llm.components import components
from filings_audit.session import materialize


@dataclass(frozen=True)
class Settings:
    """Sets are linked if 100 * intersection >= ``percent`` * union. ``block``: members of a list or group per block."""

    words: int = 5
    percent: int = 80
    keys: int = 10
    sketch: int = 64
    block: int = 1024

    @property
    def slack(self) -> float:
        """The lowest estimate of a linked pair: the threshold less five standard deviations of the sketch."""
        share = self.percent / 100
        return max(0.0, share - 5 * (share * (1 - share) / self.sketch) ** 0.5)

    @property
    def band(self) -> float:
        """Width of a band of set sizes, as a logarithm: linked sets lie in one band or in neighbours. A little wider than
        the threshold, so rounding takes no link away."""
        return max(math.log(100 / self.percent) * (1 + 1e-9), 0.01)


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of shingle hashes of texts: lower-cased A-Z, words between ASCII white space."""

    def __init__(self, words: int):
        from xxhash import xxh3_64_intdigest

        self.words, self.hash, self.known = words, xxh3_64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text with fewer words than a shingle has one, one without words none."""
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for word in set(found).difference(known):
            known[word] = self.hash(word)
        values = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        size = min(self.words, len(values))
        if not size:
            return values
        out = np.full(len(values) - size + 1, size, np.uint64)
        for k in range(size):
            out = _scramble(out * _MIX[0] + values[k : len(values) - size + 1 + k])
        return np.unique(out)


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def with_digest(docs: DataFrame, text: str) -> DataFrame:
    """All columns of ``docs`` and ``digest``: 128 bits of the set under words of ``Settings()``, null for an empty one. No column
    may be called digest."""

    def make():
        shingles = Shingles(Settings().words)
        return lambda texts: [pa.array([_digest(shingles(t)) for t in texts], pa.binary())]

    return map_texts(docs, docs.columns, text, "digest binary", make)


def sketches(docs: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null for an empty one) and sketch, per row."""

    def make():
        shingles = Shingles(settings.words)

        def sketch(texts: list) -> list:
            sizes, digests, kept = [], [], []
            for text in texts:
                values = shingles(text)
                sizes.append(len(values))
                digests.append(_digest(values))
                kept.append(values[: settings.sketch].view(np.int64))
            return [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.list_(pa.int64()))]

        return sketch

    return map_texts(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), ["doc_id"], "text",
                     "n_shingles long, digest binary, sketch array<bigint>", make)


def _cells(rows: DataFrame, key: str, settings: Settings) -> DataFrame:
    """Deal rows (key, vertex, n_shingles) into cells, so that any two that may be linked meet in one; keys of one row go.

    A key with at most ``block`` rows is one cell. Of a larger one each two neighbouring bands of set sizes are a slot: a row
    stands in the slot of its own band and in the one below. A slot whose lower band is empty holds only pairs that also
    meet in the next one, and goes. A slot with more than ``block`` rows has a cell for each pair of its blocks.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")
    dealt = rows.join(sizes, key)
    small = dealt.where(F.col("members") <= settings.block).select(key, F.lit(0).cast("long").alias("cell"), "vertex")
    band = F.floor(F.log("n_shingles") / settings.band).cast("long")
    large = dealt.where(F.col("members") > settings.block).select(key, "vertex", band.alias("band"))
    large = large.select("*", F.explode(F.array(F.col("band") - 1, "band")).alias("slot"))
    lower = F.max(F.col("band") == F.col("slot")).alias("lower")
    slots = large.groupBy(key, "slot").agg(F.count("*").alias("members"), lower).where("lower AND members > 1")
    own = F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int")
    blocks = F.ceil(F.col("members") / settings.block).cast("int")
    large = large.join(slots, [key, "slot"]).withColumn("blocks", blocks).withColumn("own", own)
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A cell of two blocks also holds the pairs inside each, so a block needs no cell of its own.
    large = large.where("blocks = 1 OR own != other")
    pair = F.least("own", "other") * F.lit(1_000_000).cast("long") + F.greatest("own", "other")
    cell = (F.col("slot") + 2) * F.lit(10**12) + pair
    return small.unionByName(large.select(key, cell.alias("cell"), "vertex"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of equal (key, cell) of a sorted partition; small neighbouring runs come together in one table."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, cells = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((keys[1:] != keys[:-1]) | (cells[1:] != cells[:-1])) + 1
        if held:
            last = held[-1]
            if last.column(0)[last.num_rows - 1].as_py() != keys[0] or last.column(1)[last.num_rows - 1].as_py() != cells[0]:
                new = np.concatenate([[0], new])
        if len(new) and rows + new[-1] > 0:
            cut = int(new[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
            rows += batch.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def _runs(table: pa.Table) -> np.ndarray:
    keys, cells = table.column(0).to_numpy(), table.column(1).to_numpy()
    change = np.flatnonzero((keys[1:] != keys[:-1]) | (cells[1:] != cells[:-1])) + 1
    return np.concatenate([[0], change, [len(keys)]])


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row, and where each list begins."""
    whole = column.combine_chunks()
    lengths = whole.value_lengths().to_numpy()
    return whole.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])


def intersections(values: np.ndarray, starts: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many values each two of the sets have in common. Values of one set alone are left out of the count."""
    n = len(starts) - 1
    member = np.repeat(np.arange(n), np.diff(starts))
    order = np.argsort(values, kind="stable")
    value, member = values[order], member[order]
    first = np.ones(len(value), bool)
    first[1:] = value[1:] != value[:-1]
    number = np.cumsum(first) - 1
    often = np.bincount(number)[number] > 1
    member, number = member[often], np.unique(number[often], return_inverse=True)[1]
    common = np.zeros((n, n), np.float32)
    total = int(number.max()) + 1 if len(number) else 0
    for low in range(0, total, width):
        a, b = np.searchsorted(number, [low, low + width])
        table = np.zeros((n, min(width, total - low)), np.float32)
        table[member[a:b], number[a:b] - low] = 1
        common += table @ table.T
    return common


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric table, from the member with most links outwards."""
    left, edges = np.ones(len(linked), bool), []
    for root in np.argsort(-linked.sum(axis=1), kind="stable").tolist():
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack and left.any():
            member = stack.pop()
            new = np.flatnonzero(linked[member] & left)
            left[new] = False
            edges.extend((member, other) for other in new.tolist())
            stack.extend(new.tolist())
    return edges


PAD = np.uint32(2**32 - 1)


def _estimates(sketch: np.ndarray, left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    """Similarity of pairs from the k smallest values of the union of their sketches (rows padded with the maximum)."""
    merged = np.sort(np.concatenate([sketch[left], sketch[right]], axis=1), axis=1)
    real = merged != PAD
    same = np.zeros_like(real)
    same[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~same, axis=1)
    size = np.minimum(rank[:, -1], k)
    return (same & (rank <= k)).sum(axis=1) / np.maximum(size, 1)


SMALL = 48
# Bits by which documents without any candidate are told before their sets are made: 8 MB.
BITS = 1 << 26


def _candidate_edges(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, slack = settings.sketch, settings.slack
        for table in _groups(batches):
            ids, runs = table["vertex"].to_numpy(), _runs(table)
            values, starts = _lists(table["sketch"])
            edges: set[tuple[int, int]] = set()
            sketch = np.full((len(ids), k), PAD)
            lengths = np.diff(starts)
            sketch[np.repeat(np.arange(len(ids)), lengths), np.arange(len(values)) - np.repeat(starts[:-1], lengths)] = values.view(np.uint32) ^ np.uint32(1 << 31)
            sizes = np.diff(runs)
            # Small lists together: members against later members of the same list, by distance.
            end = np.repeat(runs[1:], sizes)
            small = np.repeat(sizes <= SMALL, sizes)
            for distance in range(1, int(min(SMALL, sizes.max(initial=1)))):
                left = np.flatnonzero(small & (np.arange(len(ids)) + distance < end))
                for some in np.array_split(left, len(left) // 20_000 + 1):
                    fits = some[_estimates(sketch, some, some + distance, k) >= slack] if len(some) else some
                    edges.update(zip(ids[fits].tolist(), ids[fits + distance].tolist()))
            for a, b in zip(runs[:-1], runs[1:]):
                if b - a <= SMALL:
                    continue
                # In a large list the sketches' overlap bounds the estimate from above.
                size = lengths[a:b]
                overlap = intersections(values[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                linked = overlap >= slack * np.maximum(size[:, None], size[None, :])
                np.fill_diagonal(linked, False)
                edges.update((int(ids[a + i]), int(ids[a + j])) for i, j in forest(linked))
            if edges:
                yield _edge_batch(edges)

    return run


def _edge_batch(edges) -> pa.RecordBatch:
    pairs = np.array(sorted(edges), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _exact_edges(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            ids, runs = table["vertex"].to_numpy(), _runs(table)
            values, starts = _lists(table["shingles"])
            lengths, edges = np.diff(starts), []
            for a, b in zip(runs[:-1], runs[1:]):
                if b - a < 2:
                    continue
                common = intersections(values[starts[a] : starts[b]], starts[a : b + 1] - starts[a]).astype(np.int64)
                union = lengths[a:b, None] + lengths[None, a:b] - common
                linked = 100 * common >= settings.percent * union
                np.fill_diagonal(linked, False)
                edges.extend((int(ids[a + i]), int(ids[a + j])) for i, j in forest(linked))
            if edges:
                yield _edge_batch(edges)

    return run


def _in_cells(rows: DataFrame, key: str, run) -> DataFrame:
    dealt = rows.select(key, "cell", "vertex", *[c for c in rows.columns if c not in (key, "cell", "vertex")])
    return dealt.repartition(key, "cell").sortWithinPartitions(key, "cell").mapInArrow(lean(run), "u long, v long")


def _sets_of(docs: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, digest and shingles of every member of a group, and of a few others, without a shuffle of texts.

    The members' ids set bits in a table of fixed size, which the driver may hold. Rows whose bit is not set are left
    out; a full table would let more of the others through and change nothing else.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))
    found = groups.groupBy(F.floor(bit / 32).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(BITS // 32, np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(settings.words)
        for batch in batches:
            bits = batch.column(2).to_numpy(zero_copy_only=False)
            some = pa.Table.from_batches([batch]).filter(pa.array((shared.value[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 == 1))
            if some.num_rows:
                found = [shingles(t) for t in some["text"].to_pylist()]
                digests, sets = pa.array(map(_digest, found), pa.binary()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))
                ids = some["doc_id"].combine_chunks()
                yield pa.RecordBatch.from_arrays([ids, digests, sets], names=["doc_id", "digest", "shingles"])

    asked = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("bit"))
    return asked.mapInArrow(lean(run), "doc_id long, digest binary, shingles array<bigint>")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles (of the set) and component_id (smallest id reachable over links, itself included) per row.

    Texts without words are linked with nothing. Equal rows get equal results; of rows that share an id each has the
    component of its own text. A null id has a null component and links nothing. Links are confirmed on the whole sets.
    """
    return labelled(docs, settings, doc_id, text).select("doc_id", "n_shingles", "component_id")


def labelled(docs: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """The columns of ``near_duplicates``, ``digest`` and ``root``, which tell apart sets and components under one id."""
    rows = materialize(sketches(docs, settings, doc_id, text), "sketches")
    known = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # The row with the smallest id stands for its class. Copies go in every map task before the shuffle.
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("first"))
    # The table is written once, so the numbers of its rows stay, and no two sets share one.
    numbered = first.select(F.monotonically_increasing_id().alias("vertex"), "digest", F.col("first.doc_id").alias("class_id"),
                            "first.n_shingles", "first.sketch")
    members = materialize(numbered, "members")
    classes = members.select("vertex", "class_id")
    keys = members.select("vertex", "n_shingles", F.explode(F.slice("sketch", 1, settings.keys)).alias("key"))
    meeting = materialize(_cells(keys, "key", settings), "meeting")
    # The upper half of a hash does for an estimate: equal halves of different hashes only raise it.
    halves = members.select("vertex", F.transform("sketch", lambda x: (F.shiftrightunsigned(x, 32) - 2**31).cast("int")).alias("sketch"))
    candidates = _in_cells(meeting.join(halves, "vertex"), "key", _candidate_edges(settings))
    groups = components(materialize(candidates.distinct(), "candidates")).withColumnRenamed("component", "group")
    of_members = members.select("vertex", "digest", "n_shingles", F.col("class_id").alias("doc_id"))
    groups = materialize(groups.join(of_members, "vertex"), "groups")

    sets = _sets_of(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), groups, settings)
    sets = sets.join(groups.select("doc_id", "digest", "vertex"), ["doc_id", "digest"]).select("vertex", "shingles")
    meeting = materialize(_cells(groups, "group", settings), "meeting-groups")
    links = _in_cells(meeting.join(sets, "vertex"), "group", _exact_edges(settings))
    found = materialize(components(materialize(links, "links")).join(classes, "vertex"), "linked")
    least = materialize(found.groupBy("component").agg(F.min("class_id").alias("component_id")), "least-ids")
    named = found.join(least, "component").select("vertex", "component", "component_id")
    labels = members.select("vertex", "digest", "class_id").join(named, "vertex", "left").select(
        "digest", F.coalesce("component", "vertex").alias("root"), F.coalesce("component_id", "class_id").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(labels, "digest", "left").select("doc_id", "n_shingles", "digest", "root", component.alias("component_id"))
