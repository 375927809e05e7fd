"""Isolation forest (Liu, Ting and Zhou, 2008) over Spark rows.

Rows choose their trees by hash, each tree is grown in its own group of at most ``sample_size`` rows, and
the model is a DataFrame with one row per node. Its size depends on the number of trees and the sample
size alone, never on the data, which is why it may be broadcast for scoring.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.functions.scores import no_nan

# What runs on the executors travels by value: they need numpy and pandas, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double, points int"
HASH_RANGE = 1 << 31
# Expected candidates per tree, as a multiple of the sample; the smallest hashes win.
DRAW_FACTOR = 2


@dataclass(frozen=True)
class ForestParams:
    trees: int = 150
    sample_size: int = 256
    seed: int = 42


def feature_vector(columns: list[str]) -> Column:
    """Any number of numeric columns as one vector; missing values count as 0."""
    return F.array(*[F.coalesce(no_nan(F.col(c).cast("double")), F.lit(0.0)) for c in columns])


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points, the correction for unsplit leaves."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


def draw_samples(df: DataFrame, key: str, vector: str, rows: int, params: ForestParams) -> DataFrame:
    """(tree, hash, vector): up to ``sample_size`` rows per tree, the same ones however ``df`` is partitioned."""
    share = min(1.0, DRAW_FACTOR * params.sample_size / max(rows, 1))
    # One hash says whether any tree draws the row, so that the others need no hash per tree.
    drawn = min(1.0, share * params.trees)
    draw = int(HASH_RANGE * share / drawn)
    pool = df.select(key, vector).filter(
        F.pmod(F.xxhash64(F.col(key), F.lit("drawn"), F.lit(params.seed)), F.lit(HASH_RANGE)) < int(HASH_RANGE * drawn)
    )
    ticket = lambda tree: F.pmod(F.xxhash64(F.col(key), F.lit(params.seed), tree), F.lit(HASH_RANGE))
    chosen = F.filter(F.sequence(F.lit(0), F.lit(params.trees - 1)), lambda tree: ticket(tree) < draw)
    tickets = pool.select(key, vector, F.explode(chosen).alias("tree")).withColumn("ticket", ticket(F.col("tree")))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("ticket", key, vector))
    return (
        tickets.withColumn("place", place)
        .filter(F.col("place") <= params.sample_size)
        .select("tree", "place", F.col(vector).alias("vector"))
    )


def _grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path, points) of one random tree; feature -1 marks a leaf."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[tuple] = []
    pending = [(0, np.arange(len(points)), 0)]
    used = 1
    while pending:
        node, members, depth = pending.pop()
        here = points[members]
        low, high = here.min(axis=0), here.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(splittable) == 0:
            nodes.append((node, -1, 0.0, node, node, depth + float(average_path(len(members))), len(members)))
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        threshold = min(threshold, float(np.nextafter(high[feature], low[feature])))
        goes_left = here[:, feature] <= threshold
        left, right = used, used + 1
        used += 2
        nodes.append((node, feature, threshold, left, right, 0.0, len(members)))
        pending += [(left, members[goes_left], depth + 1), (right, members[~goes_left], depth + 1)]
    return nodes


def fit(df: DataFrame, key: str, vector: str, params: ForestParams = ForestParams(), rows: int | None = None) -> DataFrame:
    """R2: the trees of a forest as a DataFrame. ``key`` should identify rows.

    Two passes over two columns: the row count (skipped when given) and the hash filter. Each group handed
    to Python holds at most ``sample_size`` rows.
    """
    rows = df.count() if rows is None else rows
    seed = params.seed

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = np.vstack(group.sort_values("place")["vector"].to_numpy())
        nodes = _grow(points, np.random.default_rng([seed, tree]))
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path", "points"])
        frame.insert(0, "tree", tree)
        return frame

    return draw_samples(df, key, vector, rows, params).groupBy("tree").applyInPandas(build, TREES_SCHEMA)


class Forest:
    """A fitted forest as flat arrays, ready to broadcast. Bounded by trees x (2 x sample_size - 1) nodes."""

    def __init__(self, nodes: pd.DataFrame, sample_size: int):
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        self.roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
        start = np.repeat(self.roots, np.diff(np.append(self.roots, len(nodes))))
        feature = nodes["feature"].to_numpy()
        self.leaf = feature < 0
        self.feature = np.where(self.leaf, 0, feature).astype(np.int64)
        self.threshold = nodes["threshold"].to_numpy(dtype=float)
        # children[2 * i] is taken on <=, children[2 * i + 1] on >; a leaf leads back to itself.
        pairs = np.column_stack([nodes["left"].to_numpy() + start, nodes["right"].to_numpy() + start])
        self.children = pairs.astype(np.int64).ravel()
        self.path = nodes["path"].to_numpy(dtype=float)
        self.height = int(np.ceil(np.log2(max(sample_size, 2))))
        self.scale = float(max(average_path(sample_size), 1.0))
        # The mean depth of the sample's points below each node. Children stand behind their parents.
        points, self.expected = nodes["points"].to_numpy(dtype=float), self.path.copy()
        for at in np.flatnonzero(~self.leaf)[::-1]:
            ends = self.children[2 * at : 2 * at + 2]
            self.expected[at] = points[ends] @ self.expected[ends] / points[at]

    @classmethod
    def collect(cls, trees: DataFrame, sample_size: int) -> "Forest":
        return cls(trees.toPandas(), sample_size)

    def plain(self) -> dict:
        """The arrays alone: an executor need not know this class."""
        return dict(vars(self))

    @property
    def mean_depth(self) -> float:
        """The mean over the trees of the depth that their samples have."""
        return float(self.expected[self.roots].mean())

    def depths(self, points: np.ndarray):
        return _depths(vars(self), points)

    def score(self, points: np.ndarray) -> np.ndarray:
        return _raw_scores(vars(self), points)

    def contributions(self, points: np.ndarray) -> np.ndarray:
        return _contributions(vars(self), points)


def _walk(forest: dict, points: np.ndarray):
    """Yield tree by tree where the points stand, step by step: (nodes, the nodes they come to), the last from leaf to leaf."""
    count = len(points)
    by_feature = np.ascontiguousarray(points.T).ravel()
    row = np.arange(count)
    for root in forest["roots"]:
        steps, at = [], np.full(count, root)
        for _ in range(forest["height"]):
            value = by_feature.take(forest["feature"].take(at) * count + row)
            after = forest["children"].take(2 * at + (value > forest["threshold"].take(at)))
            steps.append((at, after))
            at = after
        yield steps, at


def _depths(forest: dict, points: np.ndarray):
    """Yield the path length of every point, tree by tree."""
    for _, leaves in _walk(forest, points):
        yield forest["path"].take(leaves)


def _raw_scores(forest: dict, points: np.ndarray) -> np.ndarray:
    """``-2^(-mean path / c)``; nearer to -1 is more anomalous."""
    mean = sum(_depths(forest, points)) / len(forest["roots"])
    return -np.exp2(-mean / forest["scale"])


def _contributions(forest: dict, points: np.ndarray) -> np.ndarray:
    """for every point and feature, by how much the splits on it change the expected depth, as a mean over the trees.

    A split moves a point from a node to a child; the change of the mean depth below belongs to the split's feature. All
    changes of a path add up to the point's depth less the mean depth of the sample.
    """
    out = np.zeros(points.shape)
    row = np.arange(len(points))
    for steps, _ in _walk(forest, points):
        for at, after in steps:
            out[row, forest["feature"].take(at)] += forest["expected"].take(after) - forest["expected"].take(at)
    return out / len(forest["roots"])


def score(df: DataFrame, forest: Forest, vector: Column | str, out: str = "ml_raw_score") -> DataFrame:
    """Add the raw score. Only the vector travels to Python; the other columns stay in the JVM."""
    model = df.sparkSession.sparkContext.broadcast(forest.plain())

    @F.pandas_udf("double")
    def raw_score(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=float)
        return pd.Series(_raw_scores(model.value, np.vstack(vectors.to_numpy())))

    return df.withColumn(out, raw_score(vector))


def depths(df: DataFrame, forest: Forest, vector: Column | str, out: str = "depths") -> DataFrame:
    """Add the depths of each record, one per tree, as an array; no row is multiplied or shuffled."""
    model = df.sparkSession.sparkContext.broadcast(forest.plain())

    @F.pandas_udf("array<double>")
    def by_tree(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        by_row = np.column_stack(list(_depths(model.value, np.vstack(vectors.to_numpy()))))
        return pd.Series(list(by_row))

    return df.withColumn(out, by_tree(vector))


def tree_depths(df: DataFrame, key: str, forest: Forest, vector: Column | str) -> DataFrame:
    """(key, tree, depth), one row per record and tree. Give it the records of interest."""
    return depths(df, forest, vector).select(key, F.posexplode("depths").alias("tree", "depth"))


def contributions(df: DataFrame, forest: Forest, vector: Column | str, names: list[str], out: str = "contributions") -> DataFrame:
    """Add a map from feature to what it adds to the record's depth; the most negative isolates it most.

    They add up to the record's mean depth less ``forest.mean_depth``. Only the vector travels to Python.
    """
    model = df.sparkSession.sparkContext.broadcast(forest.plain())

    @F.pandas_udf("array<double>")
    def shares(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(_contributions(model.value, np.vstack(vectors.to_numpy()))))

    return df.withColumn(out, F.map_from_arrays(F.array(*[F.lit(n) for n in names]), shares(vector)))


def leading_feature(contributions: Column) -> Column:
    """The feature that isolates the record most; ties go to the first in order of their names."""
    pairs = F.transform(F.map_entries(contributions), lambda e: F.struct(e["value"].alias("share"), e["key"].alias("name")))
    return F.array_min(pairs)["name"]


def fit_and_score(
    df: DataFrame, key: str, vector: str, params: ForestParams = ForestParams(), out: str = "ml_raw_score"
) -> tuple[DataFrame, Forest]:
    """Fit on ``df`` and score it. ``df`` is read several times, so hand in a table, not a long plan."""
    rows = df.count()
    sample = min(params.sample_size, max(rows, 1))
    forest = Forest.collect(fit(df, key, vector, params, rows), sample)
    return score(df, forest, vector, out), forest
