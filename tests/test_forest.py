import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from filings_audit.operators import detection, forest
from filings_audit.operators.forest import Forest, ForestParams

PARAMS = ForestParams(trees=60, sample_size=128, seed=7)


@pytest.fixture(scope="module")
def table(spark):
    """900 ordinary rows and three planted outliers, each extreme in at least two features."""
    rng = np.random.default_rng(42)
    rows = [(f"n{i}", *map(float, rng.normal((0.05, 5.0, 1.5), (0.02, 1.0, 0.2)))) for i in range(900)]
    rows += [("out1", 0.45, -25.0, 4.8), ("out2", -0.9, 60.0, 1.5), ("out3", 0.05, 90.0, 9.0)]
    frame = spark.createDataFrame(rows, "id string, revenue_growth double, operating_cash_flow double, leverage double")
    vector = forest.feature_vector(["revenue_growth", "operating_cash_flow", "leverage"])
    return frame.withColumn("vector", vector).cache()


def _scores(df):
    scored, _ = forest.fit_and_score(df, "id", "vector", PARAMS)
    return {r.id: r.ml_raw_score for r in scored.collect()}


def test_outliers_rank_on_top_and_scores_are_in_range(table):
    scores = _scores(table)
    assert set(sorted(scores, key=scores.get)[:3]) == {"out1", "out2", "out3"}
    assert all(-1 < s < 0 for s in scores.values())


def test_same_result_however_partitioned(table):
    assert _scores(table) == _scores(table.repartition(9)) == _scores(table.orderBy(F.desc("id")).coalesce(1))


def test_planted_outlier_is_flagged_by_both_layers(table):
    scored, _ = forest.fit_and_score(table, "id", "vector", PARAMS)
    rows = {r.id: r for r in detection.dual_layer(scored, 0.01).collect()}
    assert rows["out1"].triage_priority == 2
    assert sum(r.ml_anomaly_flag for r in rows.values()) == pytest.approx(0.01 * 903, abs=2)
    live = detection.live_flags(scored, 0.08).agg(F.max("ml_anomaly_score"), F.min("ml_anomaly_score"),
                                                  F.count_if("ml_anomaly_flag")).first()
    assert live[0] == pytest.approx(1, abs=1e-6) and live[1] == 0
    assert live[2] == pytest.approx(0.08 * 903, abs=3)


def test_every_tree_gets_a_full_sample_and_stays_bounded(table):
    sizes = forest.draw_samples(table, "id", "vector", 903, PARAMS).groupBy("tree").count().collect()
    assert len(sizes) == PARAMS.trees and {r["count"] for r in sizes} == {PARAMS.sample_size}
    nodes = forest.fit(table, "id", "vector", PARAMS).groupBy("tree").count().agg(F.max("count")).first()[0]
    assert nodes <= 2 * PARAMS.sample_size - 1


def test_large_table_draws_from_a_pool(spark):
    rows = 40_000
    frame = spark.range(rows).select(F.col("id").cast("string").alias("id"), F.array(F.rand(1)).alias("vector"))
    params = ForestParams(trees=10, sample_size=64)
    drawn = forest.draw_samples(frame, "id", "vector", rows, params)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {64}
    # Samples of different trees differ, and none repeats a row.
    ids = drawn.join(frame.withColumnRenamed("vector", "v"), F.expr("vector = v")).select("tree", "id")
    assert ids.distinct().count() == 640
    assert ids.select("id").distinct().count() > 500


def test_small_and_constant_inputs(spark):
    frame = spark.createDataFrame([(str(i), [1.0, 2.0]) for i in range(5)], "id string, vector array<double>")
    scores = {r.ml_raw_score for r in forest.fit_and_score(frame, "id", "vector", PARAMS)[0].collect()}
    assert len(scores) == 1 and -1 <= scores.pop() < 0
    single = forest.fit_and_score(frame.limit(1), "id", "vector", PARAMS)[0].collect()
    assert len(single) == 1 and single[0].ml_raw_score == -1


def _walk(nodes: pd.DataFrame, tree: int, point) -> float:
    """Follow one point down one tree, row by row."""
    rows = nodes[nodes.tree == tree].set_index("node")
    at = 0
    while rows.loc[at, "feature"] >= 0:
        step = "left" if point[rows.loc[at, "feature"]] <= rows.loc[at, "threshold"] else "right"
        at = rows.loc[at, step]
    return rows.loc[at, "path"]


def test_scores_equal_a_plain_walk(table):
    trees = forest.fit(table, "id", "vector", PARAMS).toPandas()
    model = Forest(trees, PARAMS.sample_size)
    points = np.array([r.vector for r in table.limit(15).collect()])
    depths = np.column_stack(list(model.depths(points)))
    for i in (0, 7, 14):
        for tree in (0, 31, 59):
            assert depths[i, tree] == pytest.approx(_walk(trees, tree, points[i]))
    expected = -(2 ** (-depths.mean(axis=1) / float(forest.average_path(PARAMS.sample_size))))
    assert np.allclose(model.score(points), expected)


def test_average_path():
    assert list(forest.average_path([0, 1, 2])) == [0, 0, 1]
    harmonic = sum(1 / k for k in range(1, 256))
    assert float(forest.average_path(256)) == pytest.approx(2 * harmonic - 2 * 255 / 256, rel=1e-3)


def test_depths_average_to_the_score(spark, table):
    scored, model = forest.fit_and_score(table, "id", "vector", PARAMS)
    few = scored.filter("id like 'out%'")
    per_tree = forest.tree_depths(few, "id", model, "vector")
    assert per_tree.count() == 3 * PARAMS.trees
    mean = {r.id: r[1] for r in per_tree.groupBy("id").agg(F.avg("depth")).collect()}
    for row in few.collect():
        assert row.ml_raw_score == pytest.approx(-(2 ** (-mean[row.id] / model.scale)), abs=1e-6)


def test_missing_features_count_as_zero(one):
    row = one((None, float("nan"), 2), "a double, b double, c int", v=forest.feature_vector(["a", "b", "c"]))
    assert row["v"] == [0.0, 0.0, 2.0]


def test_contributions_add_up_and_name_what_is_odd(table):
    names = ["revenue_growth", "operating_cash_flow", "leverage"]
    scored, model = forest.fit_and_score(table, "id", "vector", PARAMS)
    told = forest.contributions(scored, model, "vector", names).withColumn("lead", forest.leading_feature(F.col("contributions")))
    rows = {r.id: r for r in told.collect()}
    for r in rows.values():
        depth = -np.log2(-r.ml_raw_score) * model.scale
        assert sum(r.contributions.values()) == pytest.approx(depth - model.mean_depth, abs=1e-9)
    assert rows["out2"].lead in ("revenue_growth", "operating_cash_flow") and rows["out3"].lead != "revenue_growth"
    # By hand for one record: the nodes on its path in every tree.
    nodes = forest.fit(table, "id", "vector", PARAMS).toPandas()
    point, total = rows["out1"].vector, np.zeros(3)
    for _, tree in nodes.groupby("tree"):
        tree = tree.set_index("node")

        def mean(at):
            n = tree.loc[at]
            if n.feature < 0:
                return n.path
            a, b = int(n.left), int(n.right)
            return (tree.loc[a].points * mean(a) + tree.loc[b].points * mean(b)) / n.points

        at = 0
        while tree.loc[at].feature >= 0:
            n = tree.loc[at]
            after = int(n.left if point[int(n.feature)] <= n.threshold else n.right)
            total[int(n.feature)] += mean(after) - mean(at)
            at = after
    assert np.allclose(total / PARAMS.trees, [rows["out1"].contributions[n] for n in names], atol=1e-9)


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # of the driver alone
from filings_audit.session import build_session
from filings_audit.operators import forest
spark = build_session("alone", "local[2]", {{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
probe = spark.range(1).select(forest.F.lit(1)).mapInPandas(lambda b: ([__import__("pandas").DataFrame({{"n": [int(bool(__import__("importlib.util").util.find_spec("filings_audit")))]}})]), "n int")
assert probe.first()[0] == 0, "the workers see the package"
rows = spark.range(400).selectExpr("string(id) AS id", "array(double(id), double(id % 7)) AS vector")
scored, model = forest.fit_and_score(rows, "id", "vector", forest.ForestParams(trees=5, sample_size=32))
told = forest.contributions(scored, model, "vector", ["a", "b"])
assert told.filter("ml_raw_score < 0 AND size(contributions) = 2").count() == 400
assert forest.tree_depths(rows, "id", model, "vector").count() == 2000
{more}
print("done")
"""


def run_alone(tmp_path, more=""):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "alone.py"
    script.write_text(SCRIPT.format(repo=repo, more=more))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "done" in done.stdout, done.stderr[-3000:]


def test_executors_need_not_have_the_package(tmp_path):
    run_alone(tmp_path)
