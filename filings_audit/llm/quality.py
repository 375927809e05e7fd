"""Quality classifier: random-indexing word vectors, pooled per document, and a small network with calibrated output.

Every word has a fixed sparse index vector drawn from its hash. A word's vector is the sum of the index vectors of its
neighbours over all documents; words that stand in like places get like vectors. Words share a fixed number of
hash buckets, so the table of vectors has a fixed size. A document is the mean of its words' vectors and the mean step
from each word to the next. A network with one hidden layer is fitted to a bounded sample of the labelled documents,
and the temperature of its output to a part of that sample that the network has not seen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filings_audit.llm.common import held_out, lean, map_texts, pieces, sample_by_hash


@dataclass(frozen=True)
class Settings:
    """``labelled``: about so many labelled rows are learnt from, chosen by hash; all else covers all rows."""

    buckets: int = 1 << 14
    width: int = 32
    nonzero: int = 4
    hidden: int = 32
    epochs: int = 60
    labelled: int = 20_000
    seed: int = 7


class Model(NamedTuple):
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float


_tokens = re.compile(r"\w+|[^\w\s]").findall
CACHE = 32 << 20  # characters and numbers of the chunks that a task remembers


class Buckets:
    """Texts as bucket numbers. Tokens never span white space, so each distinct chunk between it is cut once."""

    def __init__(self, number: int):
        self.number, self.known, self.size = number, {}, 0

    def _learn(self, chunks: set[str]) -> None:
        for chunk in chunks:
            numbers = [zlib.crc32(word.encode()) % self.number for word in _tokens(chunk)]
            self.known[chunk] = np.array(numbers, "<i4").tobytes()
            self.size += 150 + len(chunk) + 4 * len(numbers)

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All bucket numbers in a row, and how many each text has."""
        out = []
        for text in texts:
            own = []
            for piece in pieces(text or ""):
                chunks = piece.split()
                if self.size > CACHE:
                    self.known.clear()
                    self.size = 0
                self._learn(set(chunks).difference(self.known))
                own.append(b"".join(map(self.known.__getitem__, chunks)))
            out.append(b"".join(own))
        return np.frombuffer(b"".join(out), "<i4"), np.array([len(numbers) // 4 for numbers in out], np.int64)


def index_vectors(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    random = np.random.default_rng(settings.seed)
    places = random.permuted(np.tile(np.arange(settings.width), (settings.buckets, 1)), axis=1)[:, : settings.nonzero]
    signs = random.choice([-1, 1], (settings.buckets, settings.nonzero))
    return places.astype(np.int64), signs.astype(np.float64)


def word_vectors(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> np.ndarray:
    """The vector of every bucket, from all texts, scaled to length 1; zeros for buckets without neighbours.

    A task adds up a table of fixed size and emits it once; Spark sums the tables by bucket.
    """
    width, number = settings.width, settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(settings)
        buckets = Buckets(number)
        total = np.zeros(number * width)
        for batch in batches:
            flat, sizes = buckets(batch.column(0).to_pylist())
            if len(flat) < 2:
                continue
            inside = np.ones(len(flat) - 1, bool)  # both neighbours in one text
            ends = np.cumsum(sizes)
            inside[ends[(ends > 0) & (ends < len(flat))] - 1] = False
            left, right = flat[:-1][inside].astype(np.int64), flat[1:][inside].astype(np.int64)
            # Count pairs of buckets first: frequent pairs are added once.
            pairs, counts = np.unique(left * number + right, return_counts=True)
            left, right = pairs // number, pairs % number
            for word, neighbour in ((left, right), (right, left)):
                for k in range(settings.nonzero):
                    at = word * width + places[neighbour, k]
                    total += np.bincount(at, signs[neighbour, k] * counts, number * width)
        table = total.reshape(number, width).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        for part in np.array_split(used, max(1, len(used) // 4096)):
            arrays = [pa.array(part), *(pa.array(table[part, k]) for k in range(width))]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *names])

    names = [f"v{k}" for k in range(width)]
    sums = docs.select(docs[text]).mapInArrow(lean(run), ", ".join(["bucket long", *(f"{n} long" for n in names)]))
    rows = sums.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((number, width))
    columns = [rows.column(n).to_numpy() for n in names]
    out[rows.column("bucket").to_numpy()] = np.stack(columns, axis=1) if rows.num_rows else np.zeros((0, width))
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(flat: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each text's words and mean step from a word to the next; zeros for a text without words."""
    width = vectors.shape[1]
    out = np.zeros((len(sizes), 2 * width))
    ends = np.cumsum(sizes)
    # Texts are taken in groups of bounded size.
    groups = np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(ends // 100_000)) + 1)
    for group in groups:
        some = group[sizes[group] > 0]
        if not len(some):
            continue
        first = int(ends[some[0]] - sizes[some[0]])
        chosen = vectors[flat[first : ends[some[-1]]]]
        starts = ends[some] - sizes[some] - first
        n = sizes[some][:, None]
        step = np.zeros_like(chosen)
        np.abs(np.diff(chosen, axis=0), out=step[1:])
        step[starts] = 0
        out[some, :width] = np.add.reduceat(chosen, starts, axis=0, dtype=np.float64) / n
        out[some, width:] = np.add.reduceat(step, starts, axis=0, dtype=np.float64) / n
    return out


def _logits(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2[0]


def fit_network(x: np.ndarray, y: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """Adam on the log loss, with a little weight decay. The same rows in the same order give the same network."""
    random = np.random.default_rng(settings.seed)
    hidden = settings.hidden
    layers = [random.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in layers]
    step = 0
    for epoch in range(settings.epochs):
        rate = 0.01 * (1 - epoch / settings.epochs) + 1e-4
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            a, target = x[rows], y[rows]
            before = a @ layers[0] + layers[1]
            active = np.maximum(before, 0)
            out = 1 / (1 + np.exp(-np.clip(active @ layers[2] + layers[3][0], -30, 30)))
            error = (out - target) / len(rows)
            back = np.outer(error, layers[2]) * (before > 0)
            step += 1
            for k, slope in enumerate([a.T @ back, back.sum(axis=0), active.T @ error, np.array([error.sum()])]):
                slope = slope + 1e-4 * layers[k]
                first, second = moments[k]
                first[:] = 0.9 * first + 0.1 * slope
                second[:] = 0.999 * second + 0.001 * slope**2
                layers[k] = layers[k] - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return layers


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, on a fixed grid."""
    grid = np.geomspace(0.25, 8, 61)
    losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model | None:
    """Fit to documents with a label that are not held out. None where labels of both kinds are lacking.

    Of several labels of one document the lowest counts; null ids and labels are left out. The driver receives the
    table of vectors (fixed size) and the pooled features of the sample (bounded).
    """
    known = labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("y")).where(
        "id IS NOT NULL AND y IN (0, 1)"
    )
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    # At most about settings.labelled rows of two numbers, so it may be broadcast.
    sample = F.broadcast(sample_by_hash(known, "id", settings.labelled))
    vectors = word_vectors(docs, settings, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    # Of several texts under one id one is learnt from, so the sample stays bounded.
    chosen = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).join(sample, "id")
    chosen = chosen.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def make():
        buckets = Buckets(settings.buckets)

        def features(texts: list) -> list:
            pooled = pool(*buckets(texts), shared.value)
            return [pa.array(list(pooled), pa.list_(pa.float64()))]

        return features

    rows = map_texts(chosen, ["id", "y"], "text", "x array<double>", make).toArrow()
    x = np.array(rows.column("x").to_pylist()).reshape(rows.num_rows, 2 * settings.width)
    ids, y = rows.column("id").to_pylist(), rows.column("y").to_numpy().astype(float)
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], x[i].tolist())), int)
    x, y = x[order], y[order]
    last = np.array([zlib.crc32(f"calibration {ids[i]}".encode()) % 5 == 0 for i in order], bool)
    if len(set(y[~last])) < 2:
        return None
    mean, scale = x[~last].mean(axis=0), x[~last].std(axis=0) + 1e-6
    x = np.clip((x - mean) / scale, -8, 8)
    layers = fit_network(x[~last], y[~last], settings)
    temperature = fit_temperature(_logits(layers, x[last]), y[last]) if last.any() else 1.0
    return Model(vectors, mean, scale, layers, temperature)


def score(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``keep`` and ``score``: the calibrated probability of label 1 for each whole text, from the text alone.

    Null and empty texts are scored as texts without words. Without a model every score is 0.5. Repeated rows
    are scored each.
    """
    # A plain tuple of arrays: an executor need not know the class of the model.
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))

    def make():
        plain = shared.value
        buckets = Buckets(settings.buckets)

        def scores(texts: list) -> list:
            if plain is None:
                return [pa.array([0.5] * len(texts), pa.float64())]
            vectors, mean, scale, layers, temperature = plain
            x = np.clip((pool(*buckets(texts), vectors) - mean) / scale, -8, 8)
            logits = np.clip(_logits(layers, x) / temperature, -500, 500)
            return [pa.array(1 / (1 + np.exp(-logits)), pa.float64())]

        return scores

    return map_texts(docs, keep, text, "score double", make)
